"""Reserved side: pool matching, hourly balance, daily and window unused capacity.

Partitioning. After the hourly aggregate the data is bounded by
hours-in-window x pools x raw spellings, whatever the number of billing
lines. The matched rows are hash-partitioned once on the pool key with
product (``POOL_PRODUCT_KEYS``); that partitioning satisfies the duplicate
removal, the hourly balance and both rollups, so the whole chain after the
broadcast join runs on a single exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reshift.operators.usage import EXACT, exact_sum
from reshift.params import RunParams

POOL_PRODUCT_KEYS = ("productname", "region", "availability_zone", "os", "instancetype")
BALANCE_KEYS = ("productname", "yr", "mon", "dy", "hr", "region", "availability_zone", "os",
                "instancetype")
DAY_KEYS = ("productname", "yr", "mon", "dy", "region", "availability_zone", "os", "instancetype")


def pool_match(res_hourly: DataFrame, pools: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """J1 + P9 + D1: charge each hourly row to its zonal pool and its regional pool.

    The job writes a left join; the zone filter rejects unmatched rows, so it
    is an inner join here (Catalyst does not infer that itself). A row may
    match both a zonal and a regional pool and is then charged to each.
    Exact duplicate rows are dropped afterwards, as in the job.

    No broadcast hint: the pools table has one row per pool, and the planner
    broadcasts it only while its size estimate is under
    ``spark.sql.autoBroadcastJoinThreshold`` (sort-merge join beyond it); AQE
    re-checks the measured size at run time. A hint would skip that check.
    """
    # the pools a row may belong to are named before the join, so all four keys are join keys
    charged = res_hourly.withColumn("availability_zone", F.explode(
        F.array_distinct(F.array("availabilityzone", "region"))))
    matched = charged.join(pools, ["region", "os", "instancetype", "availability_zone"], "inner")
    return (matched.select(*by, "productname", "yr", "mon", "dy", "hr", "region", "availabilityzone",
                           "os", "instancetype", "consumption", "dollar", "availability_zone",
                           "active")
            .repartition(*by, *POOL_PRODUCT_KEYS)
            .dropDuplicates())


def hourly_balance(matched: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A4 + A5 + M1 + M2: per pool-hour consumption, cost, active count and unused count.

    Every row of a pool-hour carries its pool's active count, so the job's
    ``sum(active) / count`` is that count; taken here with ``max`` in the same
    aggregate instead of the job's self-join.
    """
    agg = matched.groupBy(*by, *BALANCE_KEYS).agg(
        exact_sum("dollar").alias("dollar"),
        exact_sum("consumption").alias("consumption"),
        F.max("active").cast("decimal(17,0)").alias("active"))
    unused = (F.col("active") - F.col("consumption")).cast(EXACT)
    return agg.withColumn("unused_ri", F.when(unused < 0, F.lit(0).cast(EXACT)).otherwise(unused))


# What a day's hours add up to; sums stay exact until a rollup is read.
_SUMS = ("dollarsum", "consumptionsum", "activesum", "unused_ritotal")
_COUNTS = ("hrcount", "unused_ritotal_hrs")


def day_partials(balance: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The only aggregate over the hours: one row per pool and day, with exact sums."""
    return balance.groupBy(*by, *DAY_KEYS).agg(
        F.count("hr").alias("hrcount"), exact_sum("dollar").alias("dollarsum"),
        exact_sum("consumption").alias("consumptionsum"), F.sum("active").cast(EXACT).alias("activesum"),
        exact_sum("unused_ri").alias("unused_ritotal"),
        F.count_if(F.col("unused_ri") > 0).alias("unused_ritotal_hrs"))


def _read_out(sums: DataFrame, share: str) -> DataFrame:
    return (sums.withColumns({c: F.col(c).cast("double") for c in _SUMS})
            .withColumn(share, F.col("unused_ritotal_hrs") * 100 / F.col("hrcount")))


_MEASURES = ("hrcount", "dollarsum", "consumptionsum", "activesum", "unused_ritotal", "unused_ritotal_hrs")


def daily_of(partials: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return _read_out(partials.select(*by, *DAY_KEYS, *_MEASURES), "non_usage_hr_prop_day")


def _merged(*more):
    return [*[exact_sum(c).alias(c) if c in _SUMS else F.sum(c).alias(c) for c in _MEASURES], *more]


def window_of(partials: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return _read_out(partials.groupBy(*by, *POOL_PRODUCT_KEYS).agg(*_merged()), "non_usage_hr_prop_month")


def unused_daily(balance: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A6 + M3: per pool-day; the share is hours with spare capacity over hours observed."""
    return daily_of(day_partials(balance, by), by)


def unused_window(balance: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A7 + M4: per pool over the whole look-back window, merged from the days' partial sums.

    Only hours with some consumption are observed: a pool without any usage
    in the window does not appear (as in the job).
    """
    return window_of(day_partials(balance, by), by)


def unused_rollups(balance: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A6 and A7 at once: a row per pool with the window's measures and its ``days``, an array of daily rows.

    The hours are grouped once and the days' partial sums once more, on the partitioning that the
    balance already has. A pool has at most look-back days entries.
    """
    day = F.struct("yr", "mon", "dy", *_MEASURES)
    pools = day_partials(balance, by).groupBy(*by, *POOL_PRODUCT_KEYS).agg(
        *_merged(F.array_sort(F.collect_list(day)).alias("days")))
    return _read_out(pools, "non_usage_hr_prop_month")


def days_of(rollups: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The daily rows of ``unused_rollups``, as ``unused_daily`` gives them."""
    pool = [*by, *POOL_PRODUCT_KEYS]
    return daily_of(rollups.select(*pool, F.explode("days").alias("day")).select(*pool, "day.*"), by)


def with_idle_pools(window: DataFrame, pools: DataFrame, params: RunParams, by: tuple[str, ...] = ()) -> DataFrame:
    """A7 with pools that nobody used in the window: idle in every hour of it."""
    pool = (*by, "region", "availability_zone", "os", "instancetype")
    hours = params.lookback_days * 24
    seen = window.select(*pool).distinct()
    idle = (pools.filter(F.col("active") > 0).join(seen, list(pool), "left_anti")
            .withColumns({
                "productname": F.lit(params.idle_product), "hrcount": F.lit(hours).cast("long"),
                "dollarsum": F.lit(0.0), "consumptionsum": F.lit(0.0),
                "activesum": (F.col("active") * hours).cast("double"),
                "unused_ritotal": (F.col("active") * hours).cast("double"),
                "unused_ritotal_hrs": F.lit(hours).cast("long"),
                "non_usage_hr_prop_month": F.lit(100.0)}))
    return window.unionByName(idle.select(*window.columns))


def high_unused(window: DataFrame, cutoff_pct: float) -> DataFrame:
    """P10: pools idle in at least ``cutoff_pct`` percent of their observed hours."""
    return window.filter(F.col("non_usage_hr_prop_month") >= F.lit(float(cutoff_pct)))
