"""R1 for a list of run dates: one job over all their windows.

The run dates are a dimension. Exploded to the partitions that their windows may lie in, it is joined to the
usage table's partition column, so that dynamic partition pruning decides the scan: of a year's table two
dates far apart read their own windows, not what lies between, and windows that overlap are read once.
The hourly aggregate does not know of run dates. Its rows are joined to the dates whose windows hold
their day, and from there on the run date is one more key of every stage: same operators, same results as
one run for each date.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reshift.operators.usage import hourly_usage
from reshift.params import RunParams, parse_run_date
from reshift.plans.job import RunResult
from reshift.plans.stages import Stages
from reshift.session import materialize
from reshift.sources.sinks import SHIFT_COLUMNS, SUGGESTION_COLUMNS, write_partitions

BY = ("run_date",)


def strftime_pattern(fmt: str) -> str:
    """A partition format of Python as Spark's pattern, for the directives that dates use."""
    # fixed values: directives and their Spark letters
    letters = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%y": "yy", "%j": "DDD"}
    for directive, letter in letters.items():
        fmt = fmt.replace(directive, letter)
    if "%" in fmt:
        raise ValueError(f"partition format beyond {sorted(letters)}")
    return fmt


class Backfill(Stages):
    """All stages for many run dates; every frame from the hourly usage on has a ``run_date``."""

    def __init__(self, usage: DataFrame, reservations: DataFrame, run_dates: Iterable[dt.date | str],
                 params: RunParams = RunParams(), materialize=None):
        dates = sorted({parse_run_date(d) if isinstance(d, str) else d for d in run_dates})
        if not dates:
            raise ValueError("no run dates")
        self.run_dates, self._usage_read = dates, usage
        # one window from the first date's to the last; the dates' own windows are cut out below
        self.span = replace(params, run_date=dates[-1], lookback_days=(dates[-1] - dates[0]).days + params.lookback_days)
        super().__init__(usage, reservations, params, materialize, by=BY)

    @cached_property
    def dates(self) -> DataFrame:
        """``(run_date, day)``: each run date with the days of its window."""
        rows = self.usage.sparkSession.range(1).select(
            F.explode(F.array(*[F.lit(d) for d in self.run_dates])).alias("run_date"))
        first = F.date_sub("run_date", self.params.lookback_days - 1)
        return (rows.where(F.col("run_date") <= F.lit(self.run_dates[-1]))
                .select("run_date", F.explode(F.sequence(first, F.col("run_date"))).alias("day")))

    @cached_property
    def lines(self) -> DataFrame:
        """The usage lines of the partitions that a window may lie in."""
        column = self.params.usage_partition_column
        if not column:
            return self._usage_read
        margin = self.params.usage_partition_margin_days
        days = F.explode(F.sequence(F.date_sub("day", margin), F.date_add("day", margin)))
        parts = self.dates.select(days.alias("d")).select(
            F.date_format("d", strftime_pattern(self.params.usage_partition_format)).alias("window_partition")).distinct()
        return self._usage_read.join(parts, F.col(column).cast("string") == F.col("window_partition"), "left_semi")

    @cached_property
    def hourly_usage(self) -> DataFrame:
        hours = hourly_usage(self.lines, self.span)
        day = F.make_date("yr", "mon", "dy")
        return self._materialize(hours.withColumn("day", day).join(self.dates, "day").drop("day"))

    def _hourly(self, branch: str) -> DataFrame:
        return self.hourly_usage

    @cached_property
    def offered_pools(self) -> DataFrame:
        return self.active_pools.withColumn("run_date", F.explode(F.array(*[F.lit(d) for d in self.run_dates])))


def run_many(usage: DataFrame, reservations: DataFrame, run_dates: Iterable[dt.date | str],
             params: RunParams = RunParams(), *, suggestions_target: str | None = None,
             shifts_target: str | None = None, cut_lineage: bool = True) -> RunResult:
    """Both outputs for every run date, with a ``run_date`` in front; written, each date replaces its partition.

    ``params.run_date`` plays no part.
    """
    stages = Backfill(usage, reservations, run_dates, params, materialize if cut_lineage else None)
    result = RunResult(stages.suggestions, stages.reservation_shift, stages)
    for frame, target, columns in ((result.suggestions, suggestions_target, SUGGESTION_COLUMNS),
                                   (result.shifts, shifts_target, SHIFT_COLUMNS)):
        if target:
            dated = frame.withColumn("dt", F.date_format("run_date", "yyyyMMdd"))
            write_partitions(dated, target, [d.strftime("%Y%m%d") for d in stages.run_dates], columns)
    return result
