"""Queries of what goes beyond one plain run: both rollups at once, pairs in reach, kept hours, back-fills."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reshift.operators.balance import POOL_PRODUCT_KEYS
from reshift.plans.backfill import run_many
from reshift.plans.queries import TEST_PARAMS, as_output, stages_for
from reshift.session import checkpoint_dir
from reshift.sources.hourly_store import HourlyStore
from reshift.sources.tables import load_test_inputs

# Run dates of the registered back-fill: their 14-day windows overlap.
BACKFILL_DATES = ("20240116", "20240123", "20240130")
MEASURES = ("hrcount", "dollarsum", "consumptionsum", "activesum", "unused_ritotal", "unused_ritotal_hrs")


def unused_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily and the window rows (without a day) of every pool, from one aggregate over the hours."""
    pools = stages_for(spark, sf_dir).unused_rollups
    days = F.transform("days", lambda d: F.struct(
        *[d[c].alias(c) for c in ("yr", "mon", "dy")], *[d[c].cast(pools.schema[c].dataType).alias(c) for c in MEASURES]))
    window = F.struct(*[F.lit(None).cast("int").alias(c) for c in ("yr", "mon", "dy")], *MEASURES)
    rows = pools.select(*POOL_PRODUCT_KEYS, F.explode(F.array_append(days, window)).alias("level"))
    return rows.select(*POOL_PRODUCT_KEYS, "level.*").withColumn(
        "non_usage_hr_prop", F.col("unused_ritotal_hrs") * 100 / F.col("hrcount"))


def walk_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidate moves that the greedy walk reads."""
    return as_output(stages_for(spark, sf_dir).walk_candidates)


def incremental_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly usage of the window from a store that an earlier run has filled in part."""
    folder = checkpoint_dir(spark)
    if not folder:
        raise ValueError("spark.checkpoint.dir is unset; name a folder that all executors share")
    base = f"{folder}/reshift-hours-{uuid.uuid4().hex}"
    usage, _ = load_test_inputs(spark, sf_dir)
    usage.withColumn("dt", F.date_format("usagestartdate", "yyyyMMdd")).write.partitionBy("dt").parquet(f"{base}/usage")
    last = replace(TEST_PARAMS, usage_partition_column="dt", usage_partition_format="%Y%m%d")
    HourlyStore(spark, f"{base}/usage", f"{base}/store", replace(last, run_date="20240123")).refresh()
    return as_output(HourlyStore(spark, f"{base}/usage", f"{base}/store", last).hourly())


def _dated(frame: DataFrame) -> DataFrame:
    return as_output(frame.withColumn("dt", F.date_format("run_date", "yyyyMMdd")).drop("run_date"))


def backfill_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suggestions of several run dates from one job."""
    return _dated(run_many(*load_test_inputs(spark, sf_dir), BACKFILL_DATES, TEST_PARAMS, cut_lineage=False).suggestions)


def backfill_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reservation shifts of several run dates from one job."""
    return _dated(run_many(*load_test_inputs(spark, sf_dir), BACKFILL_DATES, TEST_PARAMS, cut_lineage=False).shifts)


def queries():
    return {f.__name__: f for f in (unused_rollups, walk_candidates, incremental_hourly, backfill_suggestions, backfill_shifts)}
