"""CPU weight of an instance type (how many CPU units one instance counts for).

The rules are rows ``(kind, key, weight, rank)`` of a dimension table that is joined in. A ``"size"`` rule
matches the text after the first run of dots (``m3.large`` -> ``large``), a ``"type"`` rule the whole
name; of the rules that match the one of the smallest rank counts (at equal rank the type rule, then the
smaller weight). A type no rule matches weighs ``DEFAULT_WEIGHT``. The rules may come from the run's
parameters or from a catalog table of any size: the lookups are plain equi-joins on the size and on the
name, which the planner broadcasts only while the rules' size is below
``spark.sql.autoBroadcastJoinThreshold``, and a (kind, key) leaves one row, so no row is multiplied.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reshift.functions.columns import size_of

# Fixed values that must equal the reference job's: its CPU rule list, in its
# order (first hit wins), and the weight of anything else.
CPU_RULES: tuple[tuple[str, str, int], ...] = (
    ("size", "large", 2),
    ("size", "xlarge", 4),
    ("size", "2xlarge", 8),
    ("size", "4xlarge", 16),
    ("type", "c4.8xlarge", 36),
    ("size", "8xlarge", 32),
    ("type", "m4.10xlarge", 40),
    ("size", "16xlarge", 64),
    ("size", "32xlarge", 128),
    ("type", "m1.medium", 1),
    ("type", "t2.nano", 1),
    ("type", "t2.small", 1),
    ("type", "m3.medium", 1),
    ("size", "medium", 2),
)
DEFAULT_WEIGHT = 1


KINDS = ("size", "type")

Rules = Sequence[tuple[str, str, int]]


def rule_rows(spark: SparkSession, rules: Rules = CPU_RULES) -> DataFrame:
    """A list of (kind, key, weight) as rules ``(kind, key, first)``, ranked in its order."""
    kept: dict[tuple[str, str], tuple[int, int]] = {}
    for rank, (kind, key, weight) in enumerate(rules):
        if kind not in KINDS:
            raise ValueError(f"unknown rule kind: {kind!r}")
        kept.setdefault((kind, key), (rank, int(weight)))
    rows = [{"kind": kind, "key": key, "first": {"rank": rank, "weight": weight}}
            for (kind, key), (rank, weight) in kept.items()]
    # one constant, whatever the number of rules
    schema = "array<struct<kind: string, key: string, first: struct<rank: int, weight: int>>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), schema)))


def rule_table(spark: SparkSession, name: str) -> DataFrame:
    """The rules of a catalog table with columns ``kind, key, weight, rank``: ``(kind, key, first)``.

    A (kind, key) that stands there more than once counts by its smallest rank, then weight. A row of
    another kind ends the run.
    """
    kind = F.when(F.col("kind").isin(*KINDS), F.col("kind")).otherwise(
        F.raise_error(F.concat(F.lit("unknown rule kind: "), F.coalesce("kind", F.lit("null")))))
    first = F.struct(F.col("rank").cast("int").alias("rank"), F.col("weight").cast("int").alias("weight"))
    return spark.table(name).groupBy(kind.alias("kind"), "key").agg(F.min(first).alias("first"))


def with_cpu_weight(df: DataFrame, type_column: str, into: str, rules: DataFrame,
                    default: int = DEFAULT_WEIGHT) -> DataFrame:
    """``df`` with the integer CPU weight of ``type_column`` as ``into``."""
    by_size, by_type = F.col(f"{into}_by_size"), F.col(f"{into}_by_type")
    sized, typed = (rules.where(F.col("kind") == kind).select(F.struct("key", "first.*").alias(f"{into}_by_{kind}"))
                    for kind in KINDS)
    met = (df.join(sized, size_of(F.col(type_column)) == by_size["key"], "left")
           .join(typed, F.col(type_column) == by_type["key"], "left"))
    first = F.when(by_type.isNull() | (by_size["rank"] < by_type["rank"]), by_size["weight"]).otherwise(by_type["weight"])
    return met.select(*df.columns, F.coalesce(first, F.lit(int(default))).cast("int").alias(into))
