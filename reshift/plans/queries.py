"""Registry of the query keys: each one is a stage of the job over the test inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reshift.params import RunParams
from reshift.plans.stages import Stages
from reshift.sources.tables import load_test_inputs

QUERY_KEYS = (
    "window_filter", "reserved_hourly", "reservation_list", "active_pools", "pool_match",
    "hourly_balance", "unused_daily", "unused_window", "high_unused", "ondemand_hourly",
    "ondemand_daily", "ondemand_window", "cpu_weight", "candidate_moves", "suggestions",
    "reservation_shift",
)

# Parameters of the registered queries (and of their DuckDB oracles).
TEST_PARAMS = RunParams(run_date="20240130", lookback_days=14, cutoff_pct=80.0)


def stages_for(spark: SparkSession, sf_dir: str, params: RunParams = TEST_PARAMS) -> Stages:
    usage_df, reservations = load_test_inputs(spark, sf_dir)
    return Stages(usage_df, reservations, params)


def as_output(df: DataFrame) -> DataFrame:
    """Exact sums leave as doubles."""
    return df.withColumns({f.name: F.col(f.name).cast("double") for f in df.schema.fields
                           if isinstance(f.dataType, T.DecimalType)})


def _query(key: str) -> Callable[[SparkSession, str], DataFrame]:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return as_output(getattr(stages_for(spark, sf_dir), key))
    build.__name__ = key
    return build


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: _query(key) for key in QUERY_KEYS}
