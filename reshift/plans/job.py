"""R1 + R2: one full run for one date.

``run`` builds one plan from the two inputs to both results. Two frames are
materialised because they are read more than once: the hourly usage
aggregate (both branches, so the billing lines are scanned once) and the
chosen moves (suggestion table and first fit). Both are small next to the
input. Nothing is collected to the driver; the only Python work is inside the
greedy walk.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from reshift.params import RunParams
from reshift.plans.stages import Stages
from reshift.session import materialize
from reshift.sources.sinks import write_partition, write_shifts, write_suggestions


@dataclass
class RunResult:
    suggestions: DataFrame
    shifts: DataFrame
    stages: Stages


def run(usage: DataFrame, reservations: DataFrame, params: RunParams = RunParams(), *,
        suggestions_target: str | None = None, shifts_target: str | None = None,
        rollups_target: str | None = None, hourly: DataFrame | None = None,
        cut_lineage: bool = True) -> RunResult:
    """Compute (and optionally write) both outputs for ``params.run_date``.

    Targets are Parquet directories or catalog tables; each write replaces
    only the run's ``dt`` partition, so a re-run is idempotent. ``rollups_target``
    takes the unused capacity of every pool, over the window and by day. ``hourly``
    is the window's hourly usage where a store keeps it (``HourlyStore.hourly``).
    """
    stages = Stages(usage, reservations, params, materialize if cut_lineage else None, hourly)
    result = RunResult(stages.suggestions, stages.reservation_shift, stages)
    if suggestions_target:
        write_suggestions(result.suggestions, suggestions_target, params.dt)
    if shifts_target:
        write_shifts(result.shifts, shifts_target, params.dt)
    if rollups_target:
        write_partition(stages.unused_rollups, rollups_target, params.dt)
    return result
