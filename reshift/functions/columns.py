"""Column expressions shared by the operators (all JVM-side, codegen-able)."""

from __future__ import annotations

import zoneinfo
from typing import TYPE_CHECKING

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

if TYPE_CHECKING:
    from reshift.params import RunParams

# Fixed values that must equal the reference job's for equal results.
EC2_PRODUCT = "amazon elastic compute cloud"
DEFAULT_INSTANCE_TYPE = "m1.small"
RESERVED_OPTION = "reservedinstance"
ON_DEMAND_OPTION = "on-demand"
HOURLY_MEASURE = "Hour"
NO_OS = "N/A"
MAX_LINE_SECONDS = 3600
WINDOWS_OS = "windows"
LINUX_OS = "linux"
ACTIVE_STATE = "active"


def ntz(value) -> Column:
    """A ``timestamp_ntz`` literal, independent of session and Python time zones."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def in_window(start: Column, params: RunParams) -> Column:
    """Start date inside ``(run_date - n, run_date]``.

    Written as a half-open range on the raw timestamp so that it reaches the
    Parquet reader as two pushed filters (and prunes date partitions).
    """
    return (start >= ntz(params.window_start)) & (start < ntz(params.window_end))


# What a stamp stored as text looks like; anything else counts as malformed.
STAMP_TEXT = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?)?$"


def wall_clock(stamp: Column, kind: T.DataType, zone: str) -> Column:
    """A stored stamp as ``timestamp_ntz``.

    A TIMESTAMP is an instant and becomes the wall clock of ``zone`` (the session's zone plays no
    part). Text is parsed, malformed text becomes null.
    """
    if isinstance(kind, T.TimestampType):
        local_micros = F.unix_micros(F.from_utc_timestamp(stamp, zone))
        return F.timestamp_add("MICROSECOND", local_micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    if isinstance(kind, T.StringType):
        return F.when(stamp.rlike(STAMP_TEXT), stamp.try_cast("timestamp_ntz"))
    return stamp


def in_stored_window(start: Column, kind: T.DataType, params: RunParams) -> Column:
    """The window as a range on the stored column, in its own type, so that it reaches the reader."""
    low, high = params.window_start, params.window_end
    if isinstance(kind, T.TimestampType):
        zone = zoneinfo.ZoneInfo(params.time_zone)
        return (start >= F.lit(low.replace(tzinfo=zone))) & (start < F.lit(high.replace(tzinfo=zone)))
    if isinstance(kind, T.StringType):  # well-formed text sorts as its date does
        return (start >= F.lit(f"{low:%Y-%m-%d}")) & (start < F.lit(f"{high:%Y-%m-%d}"))
    return in_window(start, params)


def is_ec2(product: Column) -> Column:
    return F.lower(product) == F.lit(EC2_PRODUCT)


def lasts_at_most_an_hour(start: Column, end: Column) -> Column:
    """Whole-second length <= 1 hour; negative spans pass, as in the job.

    Both stamps are instants or both are wall clocks, so no zone enters the difference.
    """
    return F.timestamp_diff("SECOND", start, end) <= MAX_LINE_SECONDS


def type_label(instancetype: Column) -> Column:
    """A missing instance type counts as the default type."""
    return F.coalesce(instancetype, F.lit(DEFAULT_INSTANCE_TYPE))


def os_label_from_description(description: Column) -> Column:
    """Reservation product description -> os label.

    Windows is tested first; anything else keeps its raw spelling.
    """
    low = F.lower(description)
    return (F.when(low.contains(WINDOWS_OS), F.lit(WINDOWS_OS))
            .when(low.contains(LINUX_OS), F.lit(LINUX_OS))
            .otherwise(description))


def family(instancetype: Column) -> Column:
    """Instance family as compared by the job: the first two characters."""
    return F.substring(instancetype, 1, 2)


def size_of(instancetype: Column) -> Column:
    """Text after the first run of dots; null when there is none."""
    return F.get(F.split(instancetype, "[.]+"), 1)


def div(a: Column, b: Column) -> Column:
    """Division that yields null on a zero divisor (ANSI mode stays on)."""
    return F.try_divide(a, b)
