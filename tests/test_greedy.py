"""The greedy walk: strict cap, running sum, claims, order, relabel."""

import pandas as pd

from reshift.operators.greedy import PICK_SCHEMA, greedy_picks, suggestions
from tests.rows import walked

EC2 = "Amazon Elastic Compute Cloud"


def cand(itype="m3.xlarge", az="us-east-1a", od_az="us-east-1b", od_type="m3.large",
         cap=10.0, shift=2.0, savings=1.0, product=EC2, region="us-east-1", os="linux",
         unit=4.0, od_unit=2.0, need=None):
    return dict(productname=product, region=region, availability_zone=az, os=os,
                instancetype=itype, avg_unused_instances=cap, availabilityzone=od_az,
                ondemand_instancetype=od_type, avg_ondemand_instances=1.0,
                instances_tobe_shifted=shift, ondemand_instances_increased=1.0, savings=savings,
                unused_instance_cpu=unit, ondemand_instance_cpu=od_unit,
                avg_ondemand_cpu_needed=shift * unit if need is None else need)


def walk(rows, **kw):
    out = walked(pd.DataFrame(rows), **kw)
    return [(r.instancetype, r.availabilityzone, r.ondemand_instancetype) for r in out.itertuples()]


def test_strict_cap():
    rows = [cand(cap=10.0, shift=10.0)]
    assert walk(rows) == []
    assert walk(rows, allow_full_use=True) == [("m3.xlarge", "us-east-1b", "m3.large")]


def test_full_use_serves_the_rest_of_a_demand():
    # 44 m3.2xlarge (8 CPU each); the first pool gives its 10 m3.xlarge (5 of them), the second its 20
    rows = [cand(az=az, od_type="m3.2xlarge", cap=n, shift=n, od_unit=8.0, need=352.0, savings=n)
            for az, n in (("us-east-1b", 10.0), ("us-east-1a", 20.0))]
    out = walked(pd.DataFrame(rows), allow_full_use=True)
    assert out["instances_tobe_shifted"].tolist() == [10.0, 20.0]
    assert out["ondemand_instances_increased"].tolist() == [5.0, 10.0]
    # a demand of 15 m3.xlarge: the second pool gives the 5 that are left, at that share of its savings
    rows = [dict(r, avg_ondemand_cpu_needed=60.0, instances_tobe_shifted=s)
            for r, s in zip(rows, (10.0, 15.0))]
    out = walked(pd.DataFrame(rows), allow_full_use=True)
    assert out["instances_tobe_shifted"].tolist() == [10.0, 5.0]
    assert out["savings"].tolist() == [10.0, 20.0 * 5 / 15]


def test_running_sum_per_pool():
    rows = [cand(shift=3.0, cap=7.0, savings=s, od_type=t)
            for s, t in [(30.0, "m3.large"), (20.0, "m3.medium"), (10.0, "m3.2xlarge")]]
    assert [r[2] for r in walk(rows)] == ["m3.large", "m3.medium"]


def test_sum_restarts_per_pool():
    rows = [cand(itype="m3.xlarge", shift=6.0, cap=7.0, od_type="m3.large"),
            cand(itype="m3.2xlarge", shift=6.0, cap=7.0, od_type="m3.medium")]
    assert len(walk(rows)) == 2


def test_claim_blocks_later_pools_and_skips_do_not_count():
    rows = [cand(itype="m3.xlarge", od_type="m3.medium", shift=5.0, cap=6.0, savings=9.0),
            cand(itype="m3.large", od_type="m3.medium", shift=5.0, cap=6.0, savings=9.0),
            cand(itype="m3.large", od_type="m3.2xlarge", shift=5.0, cap=6.0, savings=1.0)]
    # 'm3.xlarge' walks first (type descending) and claims m3.medium; the
    # skipped row of 'm3.large' does not use its cap, so its next row fits
    assert walk(rows) == [("m3.xlarge", "us-east-1b", "m3.medium"),
                          ("m3.large", "us-east-1b", "m3.2xlarge")]


def test_tie_break_and_null_savings_last():
    rows = [cand(od_az="us-east-1c", savings=5.0, shift=4.0, cap=5.0),
            cand(od_az="us-east-1b", savings=5.0, shift=4.0, cap=5.0, od_type="m3.medium"),
            cand(od_az="us-east-1a", savings=None, shift=4.0, cap=5.0)]
    assert walk(rows) == [("m3.xlarge", "us-east-1b", "m3.medium")]


def test_null_zone_demand_is_claimed_once():
    rows = [cand(itype="m3.xlarge", od_az=None), cand(itype="m3.large", od_az=None)]
    assert walk(rows) == [("m3.xlarge", None, "m3.large")]


def test_product_spellings_share_demand():
    rows = [cand(product="AMAZON ELASTIC COMPUTE CLOUD"), cand(product=EC2)]
    out = walked(pd.DataFrame(rows))
    assert list(out["productname"]) == [EC2]


def test_spark_walk_relabels_regional_pools(spark):
    rows = [cand(az="us-east-1", od_az="us-east-1b"), cand(az="us-east-1a", od_az="us-east-1c",
                                                          od_type="m3.medium"),
            cand(region="us-west-2", az="us-west-2a", od_az="us-west-2a")]
    df = spark.createDataFrame(pd.DataFrame(rows))
    got = suggestions(greedy_picks(df)).collect()
    zones = sorted((r["unused_ri_availabilityzone"], r["ondemand_availabilityzone"]) for r in got)
    assert zones == [("us-east-1", "us-east-1"), ("us-east-1a", "us-east-1c"),
                     ("us-west-2a", "us-west-2a")]


def test_empty_candidates(spark):
    empty = spark.createDataFrame([], PICK_SCHEMA.replace(", pick_order long", ""))
    out = suggestions(greedy_picks(empty))
    assert out.count() == 0 and len(out.columns) == 12


def test_components_go_on_across_batches(spark):
    rows = [cand(itype=t, region=r, az=f"{r}{z}", od_az=f"{r}{o}", od_type=d, cap=float(3 + i % 9), shift=float(1 + i % 4),
                 savings=float(i * 7 % 11))
            for i, (r, t, z, o, d) in enumerate(
                (r, t, z, o, d) for r in ("east", "west", "north") for t in ("m3.large", "m3.xlarge", "c4.large", "c4.xlarge")
                for z in "ab" for o in "abc" for d in ("m3.medium", "m3.2xlarge", "c4.2xlarge")
                if t[:2] == d[:2])]
    frame = pd.DataFrame([r for r in rows if r["instances_tobe_shifted"] < r["avg_unused_instances"]])
    expected = walked(frame).sort_values(list(frame.columns[:8]), kind="mergesort").reset_index(drop=True)
    assert len(expected) > 20
    for batch in (1, 2, 5):
        again = walked(frame, batch).sort_values(list(frame.columns[:8]), kind="mergesort").reset_index(drop=True)
        pd.testing.assert_frame_equal(again, expected)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    try:
        for batch, partitions in (("1", 8), ("3", 1), ("10000", 64)):
            spark.conf.set(size, batch)
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            got = greedy_picks(spark.createDataFrame(frame)).toPandas()
            assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, expected[got.columns].values.tolist()))
    finally:
        spark.conf.set(size, before)
        spark.conf.set("spark.sql.shuffle.partitions", 8)
