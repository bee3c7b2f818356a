"""Loading the two inputs of a run.

In production both inputs are catalog tables (``spark.table``) or Parquet
directories; for the provided test data they are derived from ``events`` and
``part`` (see ``reshift.sources.fixtures``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from reshift.sources.fixtures import reservations_from_part, usage_from_events

# Columns each operator reads; selecting them up front keeps the Parquet
# ReadSchema narrow whatever else the source table carries.
USAGE_COLUMNS = (
    "productname", "usagestartdate", "usageenddate", "region", "availabilityzone", "os",
    "instancetype", "purchaseoption", "usagequantity", "unblendedcost", "measure",
    "itemdescription",
)
RESERVATION_COLUMNS = (
    "account_id", "reserved_instance_id", "offering_type", "region", "availability_zone",
    "product_description", "instance_type", "instance_count", "state",
)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a Parquet file/directory by path."""
    if os.sep in name_or_path or name_or_path.endswith(".parquet"):
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def load_usage(spark: SparkSession, name_or_path: str, partition_column: str | None = None) -> DataFrame:
    """Usage lines with the contract columns, and the table's date partition column if it is named.

    Start and end may be stored as timestamps, with or without a zone, or as
    ``yyyy-MM-dd HH:mm:ss`` text. They are left as stored, so that the window
    reaches the reader as a range in the column's own type; the window filter
    turns them into wall clocks.
    """
    partition = [partition_column] if partition_column else []
    return read_table(spark, name_or_path).select(*USAGE_COLUMNS, *partition)


def load_reservations(spark: SparkSession, name_or_path: str) -> DataFrame:
    return read_table(spark, name_or_path).select(*RESERVATION_COLUMNS)


# The columns the fixture rules read; Parquet matches them by name, and a
# given schema spares the footer-reading job of schema inference.
EVENTS_READ_SCHEMA = ("event_id long, ts timestamp_ntz, user_id long, event_type string, "
                      "props string")
PART_READ_SCHEMA = "p_partkey long, p_size int"


def load_test_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(usage, reservations) derived from the provided tables in ``sf_dir``."""
    events = spark.read.schema(EVENTS_READ_SCHEMA).parquet(os.path.join(sf_dir, "events.parquet"))
    part = spark.read.schema(PART_READ_SCHEMA).parquet(os.path.join(sf_dir, "part.parquet"))
    return usage_from_events(events), reservations_from_part(part)
