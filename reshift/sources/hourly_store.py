"""Hourly usage kept between runs: a run scans only dates that are new or have changed.

The scheduled job reads its whole look-back window each time, though all but the newest dates were read by
the runs before. The store keeps the hourly aggregate (both branches, ``operators.usage.hourly_usage``) by
date, and beside it a ledger: for each kept date a signature of the source files it was computed from.

A date is computed from the source's partitions of the date and ``usage_partition_margin_days`` on each
side, and its signature covers the files of all of them (path, length, modification time), so a late file, a
replaced one and a deleted one all show. Signatures come from the file listing alone, as a distributed
table of one row a file; no line is read for them. The dates whose signature differs from the ledger's are
computed anew in one job and replaced, the others are read from the store.

Replacing is safe to repeat: dates first, ledger after them, each by dynamic partition overwrite. If a run
ends between the two, the next one computes the same dates again. What reaches the driver is one signature
a date of the window.

The time zone, the margin and the partition format decide which lines fall on a date; stores of different
ones lie in different folders.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reshift.operators.usage import hourly_usage
from reshift.params import RunParams

HOURLY = ("branch string, productname string, yr int, mon int, dy int, hr int, region string, availabilityzone string, "
          "os string, instancetype string, quantity decimal(28,10), cost decimal(28,10), day date")
LEDGER = "signature string, day date"


def table_location(spark: SparkSession, name_or_path: str) -> str:
    """The folder of a table's files."""
    if os.sep in name_or_path:
        return name_or_path
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name_or_path}").where("col_name = 'Location'").first()
    return described["data_type"]


@dataclass
class HourlyStore:
    """The kept hours of one usage table below ``folder`` (a path all executors share)."""

    spark: SparkSession
    usage: str
    folder: str
    params: RunParams

    def __post_init__(self):
        p = self.params
        if not p.usage_partition_column:
            raise ValueError("a store needs usage_partition_column: dates are scanned by partition")
        kind = f"{p.time_zone}|{p.usage_partition_margin_days}|{p.usage_partition_format}"
        self.root = os.path.join(self.folder, hashlib.sha256(kind.encode()).hexdigest()[:12])

    @property
    def days(self) -> list[dt.date]:
        first = self.params.window_start.date()
        return [first + dt.timedelta(days=i) for i in range(self.params.lookback_days)]

    def _partitions(self, day: dt.date) -> list[str]:
        """Values of the source's partitions that may hold lines of ``day``."""
        margin = self.params.usage_partition_margin_days
        return [(day + dt.timedelta(days=i)).strftime(self.params.usage_partition_format) for i in range(-margin, margin + 1)]

    def _sources(self, days: list[dt.date]) -> DataFrame:
        """``(day, part)``: which partitions each day is computed from."""
        pairs = [F.struct(F.lit(d).alias("day"), F.lit(p).alias("part")) for d in days for p in self._partitions(d)]
        return self.spark.range(1).select(F.inline(F.array(*pairs)))

    def signatures(self) -> DataFrame:
        """``(day, signature)`` of every day of the window, from the listing of the source's files."""
        column = self.params.usage_partition_column
        files = (self.spark.read.format("binaryFile").load(table_location(self.spark, self.usage))
                 .select(F.col(column).cast("string").alias("part"), F.xxhash64("path", "length", "modificationTime").alias("mark")))
        parts = files.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("mark").alias("mark"))
        return (self._sources(self.days).join(parts, "part", "left").groupBy("day")
                .agg(F.concat_ws(":", *[F.coalesce(x, F.lit(0)).cast("string") for x in (F.sum("n"), F.bit_xor("mark"))])
                     .alias("signature")))

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(os.path.join(self.root, name))
        except AnalysisException as e:  # a new store has no folder yet
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _replace(self, rows: DataFrame, name: str) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day")
         .parquet(os.path.join(self.root, name)))

    def stale_days(self) -> dict[dt.date, str]:
        """Days of the window that the store lacks or holds from other files, with their signatures."""
        kept = self._read("ledger", LEDGER).withColumnRenamed("signature", "kept")
        rows = self.signatures().join(kept, "day", "left").where(~F.col("signature").eqNullSafe(F.col("kept"))).collect()
        return {r["day"]: r["signature"] for r in rows}

    def _compute(self, days: list[dt.date]) -> DataFrame:
        usage = self.spark.read.parquet(self.usage) if os.sep in self.usage else self.spark.table(self.usage)
        parts = sorted({p for d in days for p in self._partitions(d)})
        lines = usage.where(F.col(self.params.usage_partition_column).isin(parts))
        day = F.make_date("yr", "mon", "dy")
        return hourly_usage(lines, self.params).withColumn("day", day).where(day.isin(days))

    def refresh(self) -> list[dt.date]:
        """Bring the window's days up to date; returns those that were scanned."""
        stale = self.stale_days()
        if stale:
            days = sorted(stale)
            # a day without rows gets one that no branch reads, so that it replaces what was there
            marks = [F.struct(F.lit(d).alias("day")) for d in days]
            empty = self.spark.range(1).select(F.inline(F.array(*marks)))
            computed = self._compute(days)
            self._replace(computed.unionByName(empty, allowMissingColumns=True).repartition("day"), "hourly")
            entries = [F.struct(F.lit(s).alias("signature"), F.lit(d).alias("day")) for d, s in sorted(stale.items())]
            self._replace(self.spark.range(1).select(F.inline(F.array(*entries))), "ledger")
        return sorted(stale)

    def hourly(self) -> DataFrame:
        """The window's hourly aggregate, as ``hourly_usage`` gives it, after a refresh."""
        self.refresh()
        first, last = self.days[0], self.days[-1]
        kept = self._read("hourly", HOURLY).where(F.col("day").between(F.lit(first), F.lit(last)))
        return kept.where(F.col("branch").isNotNull()).drop("day")
