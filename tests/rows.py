"""Hand-made input rows for unit tests."""

import datetime as dt

from pyspark.sql import types as T

USAGE_SCHEMA = T.StructType([
    T.StructField("productname", T.StringType()),
    T.StructField("usagestartdate", T.TimestampNTZType()),
    T.StructField("usageenddate", T.TimestampNTZType()),
    T.StructField("region", T.StringType()),
    T.StructField("availabilityzone", T.StringType()),
    T.StructField("os", T.StringType()),
    T.StructField("instancetype", T.StringType()),
    T.StructField("purchaseoption", T.StringType()),
    T.StructField("usagequantity", T.DoubleType()),
    T.StructField("unblendedcost", T.DoubleType()),
    T.StructField("measure", T.StringType()),
    T.StructField("itemdescription", T.StringType()),
])

RESERVATION_SCHEMA = T.StructType([
    T.StructField("account_id", T.StringType()),
    T.StructField("reserved_instance_id", T.StringType()),
    T.StructField("offering_type", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("availability_zone", T.StringType()),
    T.StructField("product_description", T.StringType()),
    T.StructField("instance_type", T.StringType()),
    T.StructField("instance_count", T.IntegerType()),
    T.StructField("state", T.StringType()),
])

EC2 = "Amazon Elastic Compute Cloud"
T0 = dt.datetime(2024, 1, 30, 10, 0, 0)


def line(start=T0, hours=1, seconds=None, **kw):
    end = start + (dt.timedelta(seconds=seconds) if seconds is not None else dt.timedelta(hours=hours))
    row = dict(productname=EC2, usagestartdate=start, usageenddate=end, region="us-east-1",
               availabilityzone="us-east-1a", os="Linux", instancetype="m3.large",
               purchaseoption="reservedinstance", usagequantity=1.0, unblendedcost=1.0,
               measure="Hour", itemdescription="per On Demand Instance Hour")
    row.update(kw)
    return row


def usage_df(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in USAGE_SCHEMA.fields) for r in rows],
                                 USAGE_SCHEMA)


def reservation(rid, count, **kw):
    row = dict(account_id="acct-0", reserved_instance_id=rid, offering_type="All Upfront",
               region="us-east-1", availability_zone="us-east-1a",
               product_description="Linux/UNIX", instance_type="m3.large",
               instance_count=count, state="active")
    row.update(kw)
    return row


def reservations_df(spark, rows):
    return spark.createDataFrame(
        [tuple(r[f.name] for f in RESERVATION_SCHEMA.fields) for r in rows], RESERVATION_SCHEMA)


def walked(frame, batch=1000, **options):
    """The picks of the greedy walk over a pandas frame of candidates, fed in batches of ``batch`` rows."""
    import pandas as pd
    import pyarrow as pa

    from reshift.operators.greedy import walk

    frame = frame.assign(family=frame["instancetype"].str[:2])
    order = ["region", "os", "family", "productname", "instancetype", "availability_zone", "savings", "availabilityzone",
             "ondemand_instancetype"]
    ordered = frame.sort_values(order, ascending=[True] * 3 + [False] * 4 + [True] * 2, na_position="last", kind="mergesort")
    table = pa.Table.from_pandas(ordered, preserve_index=False)
    picks = [b.to_pandas() for b in walk(table.to_batches(batch), **options)]
    return pd.concat([p for p in picks if len(p)] or picks[:1])
