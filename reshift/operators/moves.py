"""Candidate moves: pair idle pools with on-demand demand of the same family and price them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reshift.functions.columns import div, family, type_label
from reshift.functions.cpu import CPU_RULES, rule_rows, with_cpu_weight

CANDIDATE_KEYS = ("productname", "region", "availability_zone", "os", "instancetype",
                  "availabilityzone", "ondemand_instancetype")

CANDIDATE_COLUMNS = CANDIDATE_KEYS + (
    "hrcount", "dollarsum", "consumptionsum", "activesum", "unused_ritotal",
    "unused_ritotal_hrs", "non_usage_hr_prop_month",
    "ondemand_hrs", "quantity_used", "dollar_spent", "ondemand_days", "demand_hr_month_prop",
    "unused_instance_cpu", "ondemand_instance_cpu",
    "avg_unused_instances", "avg_ondemand_instances",
    "avg_unused_cpu_available", "avg_ondemand_cpu_needed",
    "instances_tobe_shifted", "ondemand_instances_reduced", "ondemand_instances_increased",
    "savings",
)


PAIR_KEYS = ("productname", "region", "os", "family")


def _rules(df: DataFrame, rules) -> DataFrame:
    return rules if isinstance(rules, DataFrame) else rule_rows(df.sparkSession, rules)


def instance_types(window: DataFrame, reservations: DataFrame, rules=CPU_RULES) -> DataFrame:
    """M7 as a table: every instance type of the window's lines or the inventory with its CPU weight.

    ``rules`` is a list or a table of rules (``functions.cpu``).
    """
    types = (window.select(type_label(F.col("instancetype")).alias("instancetype"))
             .union(reservations.select(F.trim(F.col("instance_type")).alias("instancetype")))
             .distinct())
    return with_cpu_weight(types, "instancetype", "cpu", _rules(window, rules))


def _sides(high: DataFrame, od_window: DataFrame, rules) -> tuple[DataFrame, DataFrame]:
    """Pools and demands with all that depends on one of them only, and the viability tests each decides alone."""
    pools = with_cpu_weight(high, "instancetype", "unused_instance_cpu", _rules(high, rules))
    pools = (pools
             .withColumns({
                 "family": family(F.col("instancetype")),
                 "avg_unused_instances": F.round(div(F.col("unused_ritotal"), F.col("hrcount"))),
             })
             .filter(F.col("avg_unused_instances") > 0)
             .withColumn("avg_unused_cpu_available",
                         F.col("avg_unused_instances") * F.col("unused_instance_cpu")))
    demand = with_cpu_weight(od_window, "ondemand_instancetype", "ondemand_instance_cpu", _rules(high, rules))
    demand = (demand
              .withColumns({
                  "family": family(F.col("ondemand_instancetype")),
                  "avg_ondemand_instances":
                      F.round(div(F.col("quantity_used"), F.col("ondemand_hrs"))),
              })
              .filter(F.col("avg_ondemand_instances") > 0)
              .withColumn("avg_ondemand_cpu_needed",
                          F.col("avg_ondemand_instances") * F.col("ondemand_instance_cpu")))
    return pools, demand


def _priced(pairs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """M10..M13 + P12 of pairs."""
    unused_cpu, od_cpu = F.col("unused_instance_cpu"), F.col("ondemand_instance_cpu")
    avail, needed = F.col("avg_unused_cpu_available"), F.col("avg_ondemand_cpu_needed")
    short = needed > avail
    moves = (pairs
             .withColumns({
                 "instances_tobe_shifted": F.when(short, F.round(div(avail, unused_cpu)))
                                            .otherwise(F.round(div(needed, unused_cpu))),
                 "ondemand_instances_reduced": F.when(short, F.round(div(avail, od_cpu)))
                                                .otherwise(F.round(div(needed, od_cpu))),
             })
             .withColumns({
                 "ondemand_instances_increased":
                     F.round(div(F.col("instances_tobe_shifted") * unused_cpu, od_cpu)),
                 "savings": F.col("instances_tobe_shifted") * F.col("ondemand_hrs")
                            * div(F.col("dollar_spent"), F.col("quantity_used")),
             }))
    viable = ((F.col("avg_unused_instances") > 0)
              & (F.col("ondemand_instances_reduced") > 0)
              & (F.col("instances_tobe_shifted") >= 1))
    return moves.filter(viable).select(*by, *CANDIDATE_COLUMNS)


def candidate_moves(high: DataFrame, od_window: DataFrame, rules=CPU_RULES, by: tuple[str, ...] = ()) -> DataFrame:
    """J3 + P11 + M7..M13 + P12.

    The job's left join is an inner join (the family filter rejects unmatched
    rows), and the family test becomes a fourth equi-key. Everything that
    depends on one side only (CPU weight, average count, CPU total) is
    computed on that side before the join, once per pool or demand rather
    than once per pair, and each side is pre-filtered by the part of the
    viability test it decides alone: a pool must average at least one unused
    instance, a demand at least one instance (with zero or less demand the
    reduction rounds to zero or less and the pair fails P12 anyway). Pairs
    per join key are then bounded by pools x demands of one family. The
    job's regrouping of the result is an identity and is not repeated.
    """
    pools, demand = _sides(high, od_window, rules)
    return _priced(pools.join(demand, [*by, *PAIR_KEYS], "inner"), by)


# CPU totals below the first power of two and from the last one on share a bin
LOWEST_BIN, HIGHEST_BIN = -1, 40


def _bin(cpu: Column) -> Column:
    """Which power of two a CPU total reaches."""
    power = F.when(cpu >= 1, F.floor(F.log2(cpu))).otherwise(LOWEST_BIN)
    return F.least(power, F.lit(HIGHEST_BIN)).cast("int")


def reachable_pairs(pools: DataFrame, demand: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The pairs of pools and demands that a walk under the strict cap can take, by a join over ordered bins.

    A pair is taken only if its shift is strictly below the pool's average unused count ``u``. Where the
    demand needs more CPU than the pool has, the shift is all of it: ``round(u * cpu / cpu) = u``, which is
    not below ``u``. So a taken pair has ``needed <= available``, and a pair that is not taken leaves no
    trace in the walk: without the others the walk makes the same picks. The CPU totals are put in order
    by powers of two; a demand stands in its bin, a pool meets the bins up to its own, and only in its own
    bin are pairs made that the comparison still rejects.
    """
    # the logarithm may err by a bin at a power of two: one bin more loses nothing, the comparison decides
    reach = F.explode(F.sequence(F.lit(LOWEST_BIN), F.least(_bin(F.col("avg_unused_cpu_available")) + 1, F.lit(HIGHEST_BIN))))
    keys = [*by, *PAIR_KEYS, "cpu_bin"]
    met = pools.withColumn("cpu_bin", reach).join(
        demand.withColumn("cpu_bin", _bin(F.col("avg_ondemand_cpu_needed"))), keys, "inner")
    return met.filter(F.col("avg_ondemand_cpu_needed") <= F.col("avg_unused_cpu_available")).drop("cpu_bin")


def walk_candidates(high: DataFrame, od_window: DataFrame, rules=CPU_RULES, by: tuple[str, ...] = ()) -> DataFrame:
    """The candidate moves that the walk under the strict cap can take (``reachable_pairs``)."""
    return _priced(reachable_pairs(*_sides(high, od_window, rules), by), by)
