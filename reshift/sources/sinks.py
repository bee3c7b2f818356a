"""Date-partitioned outputs that can be re-run safely.

A run overwrites exactly its own ``dt`` partition and leaves every other date alone: a re-run of a date
replaces it, even when the new result is empty. The target is a Parquet directory or an existing catalog
table partitioned by ``dt`` (its last column; columns are matched by position, so the frame is projected
to the contract order).

A date changes in one step. The result is computed first and kept (``session.materialize``), then written
with dynamic partition overwrite: Spark's committer writes the files to a staging folder beside the
partitions and moves them into place when all tasks have succeeded. A run that fails or is killed before
that, whether it computes or writes, leaves the old date as it was. (A static overwrite deletes the old
files first, of a directory as of a table.) Dynamic overwrite replaces only partitions that have rows, so
an empty result takes its date out instead.

Reading a Parquet target back, partition discovery types ``dt`` as an integer
unless ``spark.sql.sources.partitionColumnTypeInference.enabled`` is false.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reshift.session import materialize

# The output contracts (column order is the insert order of the job).
SUGGESTION_COLUMNS = (
    "productname", "region", "unused_ri_availabilityzone", "os", "unused_ri_instancetype",
    "avg_unused_instances", "ondemand_availabilityzone", "ondemand_instancetype",
    "avg_ondemand_instances", "instances_tobe_shifted", "ondemand_instances_increased", "savings",
)
SHIFT_COLUMNS = (
    "productname", "reserved_instance_id", "account_id", "offering_type", "instancetype",
    "region", "availability_zone", "os", "active", "ondemand_availabilityzone",
    "ondemand_instancetype", "active_instances_tobe_shifted", "savings",
)


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def write_partition(df: DataFrame, target: str, dt: str, columns=None) -> None:
    """Replace partition ``dt=<dt>`` of ``target`` with ``df``."""
    columns = list(columns) if columns is not None else df.columns
    write_partitions(df.select(*columns, F.lit(dt).alias("dt")), target, [dt], columns)


def write_partitions(df: DataFrame, target: str, dts: list[str], columns) -> None:
    """Replace the partitions ``dts`` of ``target`` with the rows of ``df``, dealt by its column ``dt``."""
    for dt in dts:
        if not dt.isalnum():
            raise ValueError(f"partition value must be alphanumeric: {dt!r}")
    out = materialize(df.select(*columns, "dt"))
    try:
        # at most one row a date
        found = {r["dt"] for r in out.select("dt").distinct().collect()}
        if unknown := found - set(dts):
            raise ValueError(f"rows of other dates: {sorted(unknown)}")
        publish, clear = (_publish_directory, _clear_directory) if os.sep in target else (_publish_table, _clear_table)
        if found:
            publish(out, target)
        for dt in sorted(set(dts) - found):
            clear(out.drop("dt"), target, dt)
    finally:
        out.unpersist()  # where there is no checkpoint folder


def _publish_directory(out: DataFrame, target: str) -> None:
    (out.write.mode("overwrite").partitionBy("dt").option("partitionOverwriteMode", "dynamic").parquet(target))


def _clear_directory(out: DataFrame, target: str, dt: str) -> None:
    # nothing to stage: an empty date is the same half-way as done
    out.limit(0).write.mode("overwrite").parquet(os.path.join(target, f"dt={dt}"))


def _publish_table(out: DataFrame, target: str) -> None:
    spark = out.sparkSession
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        out.write.insertInto(target, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def _clear_table(out: DataFrame, target: str, dt: str) -> None:
    spark = out.sparkSession
    view = f"reshift_out_{uuid.uuid4().hex}"
    out.limit(0).createOrReplaceTempView(view)
    try:
        cols = ", ".join(f"`{c}`" for c in out.columns)
        spark.sql(f"INSERT OVERWRITE TABLE {target} PARTITION (dt = '{dt}') SELECT {cols} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def write_suggestions(df: DataFrame, target: str, dt: str) -> None:
    write_partition(df, target, dt, SUGGESTION_COLUMNS)


def write_shifts(df: DataFrame, target: str, dt: str) -> None:
    write_partition(df, target, dt, SHIFT_COLUMNS)
