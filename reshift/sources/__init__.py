"""Inputs (usage lines, reservation inventory) and date-partitioned sinks."""

from reshift.sources.fixtures import reservations_from_part, usage_from_events  # noqa: F401
from reshift.sources.hourly_store import HourlyStore  # noqa: F401
from reshift.sources.sinks import write_partition, write_shifts, write_suggestions  # noqa: F401
from reshift.sources.tables import (  # noqa: F401
    load_reservations,
    load_test_inputs,
    load_usage,
    read_table,
)
