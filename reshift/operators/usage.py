"""Usage side: window filter, hourly reserved and on-demand usage, on-demand rollups.

Scale notes. The hourly aggregation is the only operator that touches the raw
billing lines; it is a hash aggregate with a map-side partial step, so a hot
pool-hour is collapsed before the shuffle. The window predicate is a range on
the raw start timestamp, pushed to the Parquet reader; with
``usage_partition_column`` set, a partition range prunes date partitions as
well. The hourly aggregate takes the set of branches it must produce: a query
that needs one branch reads only that branch's columns and rows, while
``run()`` builds both branches in one aggregate, materialises it and serves
both from a single scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reshift.functions.columns import (
    HOURLY_MEASURE,
    NO_OS,
    ON_DEMAND_OPTION,
    RESERVED_OPTION,
    div,
    in_window,
    in_stored_window,
    is_ec2,
    lasts_at_most_an_hour,
    type_label,
    wall_clock,
)
from reshift.params import RunParams

RESERVED = "reserved"
ON_DEMAND = "ondemand"
BRANCHES = (RESERVED, ON_DEMAND)
_OPTION = {RESERVED: RESERVED_OPTION, ON_DEMAND: ON_DEMAND_OPTION}

HOUR_KEYS = ("productname", "yr", "mon", "dy", "hr", "region", "availabilityzone")
DEMAND_KEYS = ("productname", "region", "availabilityzone", "os", "ondemand_instancetype")


STAMPS = ("usagestartdate", "usageenddate")
AMOUNTS = ("usagequantity", "unblendedcost")
# Quantities and costs add up exactly, in any order; a sum leaves as double once, at a rollup.
EXACT = "decimal(28,10)"


def exact_sum(column: str):
    return F.sum(F.col(column).cast(EXACT)).cast(EXACT)


def amount(column: str):
    """A quantity or cost as an exact number; text that is no number, NaN and infinities count as missing."""
    return F.col(column).try_cast(EXACT)


def window_filter(usage: DataFrame, params: RunParams) -> DataFrame:
    """Lines both branches share: EC2 (any case), at most one hour long, in the window.

    Stamps come out as ``timestamp_ntz`` in ``params.time_zone``. A line whose text stamps do not
    parse is dropped (``malformed_lines`` counts them).
    """
    start, end = (F.col(c) for c in STAMPS)
    kinds = {f.name: f.dataType for f in usage.schema.fields if f.name in STAMPS}
    cond = in_stored_window(start, kinds[STAMPS[0]], params) & is_ec2(F.col("productname"))
    if params.usage_partition_column:
        low, high = params.partition_bounds
        cond = F.col(params.usage_partition_column).between(low, high) & cond
    clocks = {c: wall_clock(F.col(c), kinds[c], params.time_zone) for c in STAMPS
              if not isinstance(kinds[c], T.TimestampNTZType)}
    if all(isinstance(k, T.TimestampType) for k in kinds.values()):
        # two instants: their distance is taken before wall clocks may jump
        return usage.filter(cond & lasts_at_most_an_hour(start, end)).withColumns(clocks)
    lines = usage.filter(cond)
    lines = lines.withColumns(clocks) if clocks else lines
    return lines.filter(in_window(start, params) & lasts_at_most_an_hour(start, end))


def malformed_lines(usage: DataFrame, params: RunParams | None = None) -> DataFrame:
    """One row: ``n`` lines with a text stamp that is there but does not parse, and ``amounts``, lines with
    a text quantity or cost that is there but is no number (it adds nothing to its group's sum).

    With ``params`` only the window's partitions are read, where the table has any.
    """
    if params and params.usage_partition_column:
        usage = usage.where(F.col(params.usage_partition_column).between(*params.partition_bounds))
    texts = {f.name: f.dataType for f in usage.schema.fields if isinstance(f.dataType, T.StringType)}
    bad = lost = F.lit(False)
    for name in STAMPS:
        if name in texts:
            bad = bad | (F.col(name).isNotNull() & wall_clock(F.col(name), texts[name], "UTC").isNull())
    for name in AMOUNTS:
        if name in texts:
            lost = lost | (F.col(name).isNotNull() & amount(name).isNull())
    return usage.agg(F.count_if(bad).alias("n"), F.count_if(lost).alias("amounts"))


def _branch_test(branch: str):
    """Predicate of the lines that feed one hourly table."""
    if branch == RESERVED:
        return F.col("purchaseoption") == RESERVED_OPTION
    desc = F.col("itemdescription")
    return ((F.col("purchaseoption") == ON_DEMAND_OPTION)
            & (F.instr(F.lower(desc), "instance") > 0)
            & ~(F.instr(desc, "Mbps") > 0)  # case-sensitive, as in the job
            & (F.col("measure") == HOURLY_MEASURE)
            & (F.col("os") != NO_OS))


def _branch(branches):
    """Which hourly table a line feeds, or null when none of ``branches``."""
    expr = None
    for b in branches:
        expr = (F.when if expr is None else expr.when)(_branch_test(b), F.lit(b))
    return expr


def hourly_usage(usage: DataFrame, params: RunParams, branches=BRANCHES) -> DataFrame:
    """The hourly tables of ``branches`` in one aggregate, keyed by ``branch``.

    The group key is the *raw* os and instance type: two spellings of one
    label ('Linux'/'linux', null/'m1.small') stay separate rows with equal
    labels, as in the job. Labels are projected after the aggregate.
    """
    start = F.col("usagestartdate")
    lines = (window_filter(usage, params)
             # redundant with the branch test, but a plain IN list reaches the
             # Parquet reader (row-group skipping); the CASE expression does not
             .filter(F.col("purchaseoption").isin(*[_OPTION[b] for b in branches]))
             .withColumn("branch", _branch(branches))
             .filter(F.col("branch").isNotNull()))
    grouped = lines.groupBy(
        "branch", "productname",
        F.year(start).alias("yr"), F.month(start).alias("mon"),
        F.dayofmonth(start).alias("dy"), F.hour(start).alias("hr"),
        "region", "availabilityzone",
        F.col("os").alias("os_raw"), F.col("instancetype").alias("type_raw"),
    ).agg(F.sum(amount("usagequantity")).cast(EXACT).alias("quantity"),
          F.sum(amount("unblendedcost")).cast(EXACT).alias("cost"))
    return grouped.select(
        "branch", *HOUR_KEYS,
        F.lower("os_raw").alias("os"), type_label(F.col("type_raw")).alias("instancetype"),
        "quantity", "cost")


# ``by`` names further key columns that all frames of a stage carry through: the run date of a back-fill.

def reserved_hourly(hourly: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A1: reserved consumption per pool-hour (raw-key groups)."""
    return hourly.filter(F.col("branch") == RESERVED).select(
        *by, *HOUR_KEYS, "os", "instancetype",
        F.col("quantity").alias("consumption"), F.col("cost").alias("dollar"))


def ondemand_hourly(hourly: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A8: on-demand usage per hour (raw-key groups)."""
    return hourly.filter(F.col("branch") == ON_DEMAND).select(
        *by, *HOUR_KEYS, "os", F.col("instancetype").alias("ondemand_instancetype"),
        F.col("quantity").alias("quantity_used"), F.col("cost").alias("dollar_spent"))


def _demand_clustered(od_hourly: DataFrame, by: tuple[str, ...]) -> DataFrame:
    # Both rollups group by a superset of the demand key: one exchange serves
    # both (and the distinct-day count), with rows per key bounded by
    # hours-in-window x raw spellings, never by the number of billing lines.
    return od_hourly.repartition(*by, *DEMAND_KEYS)


def ondemand_daily(od_hourly: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A9 + M5: on-demand rows per day. ``ondemand_hrs`` counts rows, as in the job."""
    return (_demand_clustered(od_hourly, by)
            .groupBy(*by, "productname", "yr", "mon", "dy", "region", "availabilityzone", "os",
                     "ondemand_instancetype")
            .agg(F.count("hr").alias("ondemand_hrs"),
                 exact_sum("dollar_spent").cast("double").alias("dollar_spent"),
                 exact_sum("quantity_used").cast("double").alias("quantity_used"))
            .withColumn("demand_hr_day_prop", F.col("ondemand_hrs") * 100 / 24))


def ondemand_window(od_hourly: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A10 + M6: on-demand over the whole window; days are distinct days of month.

    A demand's days are bits of one number, so they are counted by the same partial and final
    aggregate as the sums: no row is expanded or grouped a second time for them.
    """
    days = F.bit_count(F.bit_or(F.expr("shiftleft(1L, dy)")))
    return (_demand_clustered(od_hourly, by)
            .groupBy(*by, *DEMAND_KEYS)
            .agg(F.count("hr").alias("ondemand_hrs"),
                 exact_sum("dollar_spent").cast("double").alias("dollar_spent"),
                 exact_sum("quantity_used").cast("double").alias("quantity_used"),
                 days.cast("long").alias("ondemand_days"))
            .withColumn("demand_hr_month_prop",
                        div(F.col("ondemand_hrs") * 100, F.col("ondemand_days") * 24)))
