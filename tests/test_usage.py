"""Usage side on hand-made rows: filters, raw-key grouping, rollups."""

import datetime as dt

from reshift.operators import usage as U
from reshift.params import RunParams
from tests.rows import T0, line, usage_df

P = RunParams(run_date="20240130", lookback_days=14)


def hourly(spark, rows, branch="reserved"):
    h = U.hourly_usage(usage_df(spark, rows), P)
    df = U.reserved_hourly(h) if branch == "reserved" else U.ondemand_hourly(h)
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_window_is_half_open_and_exactly_n_days(spark):
    rows = [line(start=dt.datetime(2024, 1, 16, 23)), line(start=dt.datetime(2024, 1, 17, 0)),
            line(start=dt.datetime(2024, 1, 30, 23)), line(start=dt.datetime(2024, 1, 31, 0))]
    got = U.window_filter(usage_df(spark, rows), P).select("usagestartdate").collect()
    assert sorted(r[0] for r in got) == [dt.datetime(2024, 1, 17, 0), dt.datetime(2024, 1, 30, 23)]


def test_line_length_inclusive_and_negative_passes(spark):
    rows = [line(seconds=3600, usagequantity=1.0), line(seconds=3601, usagequantity=2.0),
            line(seconds=-60, usagequantity=4.0)]
    got = U.window_filter(usage_df(spark, rows), P).select("usagequantity").collect()
    assert sorted(r[0] for r in got) == [1.0, 4.0]


def test_product_case_folded_but_spelling_kept(spark):
    rows = [line(productname="AMAZON ELASTIC COMPUTE CLOUD"), line(),
            line(productname="Amazon Simple Storage Service"), line(productname=None)]
    got = hourly(spark, rows)
    assert sorted(r[0] for r in got) == ["AMAZON ELASTIC COMPUTE CLOUD", "Amazon Elastic Compute Cloud"]


def test_group_by_raw_os_and_type(spark):
    rows = [line(os="Linux", usagequantity=1.0), line(os="linux", usagequantity=2.0),
            line(instancetype=None, usagequantity=4.0), line(instancetype="m1.small", usagequantity=8.0)]
    got = hourly(spark, rows)
    labels = sorted((r[7], r[8], r[9]) for r in got)
    # 'Linux' and 'linux' stay two rows with one label; null type and 'm1.small' too
    assert labels == [("linux", "m1.small", 4.0), ("linux", "m1.small", 8.0),
                      ("linux", "m3.large", 1.0), ("linux", "m3.large", 2.0)]


def test_purchase_option_is_case_sensitive(spark):
    rows = [line(purchaseoption="ReservedInstance"), line(purchaseoption="reservedinstance")]
    assert len(hourly(spark, rows)) == 1


def test_ondemand_filters(spark):
    od = dict(purchaseoption="on-demand")
    rows = [
        line(**od, usagequantity=1.0),                                          # kept
        line(**od, itemdescription="data transfer 10 Mbps per Instance", usagequantity=2.0),
        line(**od, itemdescription="data transfer 10 mbps per instance", usagequantity=4.0),  # kept
        line(**od, itemdescription="EBS snapshot", usagequantity=8.0),
        line(**od, itemdescription=None, usagequantity=16.0),
        line(**od, measure="GB", usagequantity=32.0),
        line(**od, os="N/A", usagequantity=64.0),
        line(**od, os="n/a", usagequantity=128.0),                              # kept (raw test)
        line(**od, os=None, usagequantity=256.0),
        line(**od, itemdescription="PER ON DEMAND INSTANCE HOUR", usagequantity=512.0),  # kept
    ]
    got = hourly(spark, rows, branch="ondemand")
    assert sorted(r[9] for r in got) == [128.0, 1.0 + 4.0 + 512.0]


def test_hour_parts(spark):
    got = hourly(spark, [line(start=dt.datetime(2024, 1, 29, 13, 0))])
    assert got[0][1:5] == (2024, 1, 29, 13)


def test_ondemand_rollups_count_rows_and_distinct_days(spark):
    od = dict(purchaseoption="on-demand")
    rows = [line(**od, start=T0, os="Linux"), line(**od, start=T0, os="linux"),
            line(**od, start=T0 + dt.timedelta(hours=1)),
            line(**od, start=T0 - dt.timedelta(days=1))]
    h = U.ondemand_hourly(U.hourly_usage(usage_df(spark, rows), P))
    w = U.ondemand_window(h).collect()
    assert len(w) == 1
    # four hourly rows (two spellings share an hour), two distinct days
    assert (w[0]["ondemand_hrs"], w[0]["ondemand_days"]) == (4, 2)
    assert w[0]["demand_hr_month_prop"] == 4 * 100 / (2 * 24)
    d = {r["dy"]: r["ondemand_hrs"] for r in U.ondemand_daily(h).collect()}
    assert d == {30: 3, 29: 1}


def test_long_lookback_counts_days_of_month(spark):
    # a look-back over a month boundary: the 5th of two months is one distinct day
    params = RunParams(run_date="20240210", lookback_days=40)
    od = dict(purchaseoption="on-demand")
    rows = [line(**od, start=dt.datetime(2024, 1, 5, 3)), line(**od, start=dt.datetime(2024, 2, 5, 3))]
    h = U.ondemand_hourly(U.hourly_usage(usage_df(spark, rows), params, (U.ON_DEMAND,)))
    (w,) = U.ondemand_window(h).collect()
    assert (w["ondemand_hrs"], w["ondemand_days"]) == (2, 1)


def test_distinct_days_are_bits_of_one_aggregate(spark):
    from reshift.operators import usage as U
    from reshift.plans.queries import stages_for
    from tests.conftest import SF_SMALL

    days = [1, 1, 2, 31, 31, 30, 15]
    hours = spark.createDataFrame(
        [("p", 2024, 1, d, 3, "r", None, "linux", "m3.large", 1.0, 1.0) for d in days] +
        [("p", 2024, 2, 31, 3, "r", "z", "linux", "m3.large", 1.0, 1.0)],
        "productname string, yr int, mon int, dy int, hr int, region string, availabilityzone string, os string, "
        "ondemand_instancetype string, quantity_used double, dollar_spent double")
    got = {r["availabilityzone"]: r["ondemand_days"] for r in U.ondemand_window(hours).collect()}
    assert got == {None: 5, "z": 1}
    plan = stages_for(spark, SF_SMALL).ondemand_window._jdf.queryExecution().optimizedPlan().toString()
    assert "distinct" not in plan.lower() and "Expand" not in plan and plan.count("bit_or(") == 1


def test_amounts_that_are_no_numbers_count_as_missing(spark):
    from pyspark.sql import functions as F

    from reshift.operators import usage as U
    from reshift.plans.queries import TEST_PARAMS
    from tests.rows import line, usage_df

    lines = usage_df(spark, [line(usagequantity=q) for q in (2.0, 3.0, float("nan"), None)])
    (hour,) = U.hourly_usage(lines, TEST_PARAMS).collect()
    assert hour["quantity"] == 5
    text = lines.withColumn("usagequantity", F.when(F.col("usagequantity") == 3.0, "n/a").otherwise(
        F.col("usagequantity").cast("string")))
    (hour,) = U.hourly_usage(text, TEST_PARAMS).collect()
    assert hour["quantity"] == 2
    assert U.malformed_lines(text).first()["amounts"] == 2  # 'n/a' and the text 'NaN'
