"""Wiring of the operators: lazily built stages, the full run, query registry, oracles."""
