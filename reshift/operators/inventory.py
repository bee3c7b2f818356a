"""Inventory side: reservation list and active pools."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reshift.functions.columns import ACTIVE_STATE, os_label_from_description

POOL_KEYS = ("region", "availability_zone", "os", "instancetype")
# First-fit order of reservations: the raw inventory key, ascending.
RESERVATION_ORDER = ("account_id", "reserved_instance_id", "offering_type", "region",
                     "availability_zone", "product_description", "instance_type")


def reservation_list(reservations: DataFrame) -> DataFrame:
    """A2: active instance count per reservation row.

    Grouped by the raw description and raw type, so one reservation id may
    give two rows ('m3.large' and 'm3.large '); labels are projected after the
    aggregate and the raw columns are kept as the first-fit order key.
    """
    return (reservations.filter(F.col("state") == ACTIVE_STATE)
            .groupBy(*RESERVATION_ORDER)
            .agg(F.sum("instance_count").cast("long").alias("active"))
            .select("account_id", "reserved_instance_id", "offering_type", "region",
                    "availability_zone",
                    os_label_from_description(F.col("product_description")).alias("os"),
                    F.trim(F.col("instance_type")).alias("instancetype"),
                    "active", "product_description", "instance_type"))


def active_pools(res_list: DataFrame) -> DataFrame:
    """A3: active count per pool (region, availability zone or region, os, type).

    A regional reservation carries the region name as its availability zone.
    The result has one row per pool, so its size is bounded by the catalogue
    (regions x zones x os labels x instance types), not by the data.
    """
    return res_list.groupBy(*POOL_KEYS).agg(F.sum("active").alias("active"))
