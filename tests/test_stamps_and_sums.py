"""Time zones, text stamps, exact sums, CPU rules and idle pools."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from reshift.operators import usage as U
from reshift.params import RunParams
from reshift.plans.queries import TEST_PARAMS, stages_for
from reshift.plans.stages import Stages
from reshift.sources.tables import load_test_inputs, load_usage
from tests.conftest import SF_MEDIUM, SF_SMALL
from tests.rows import line, reservation, reservations_df, usage_df
from tests.test_plans import explain


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def instants(spark):
    """The small usage table with TIMESTAMP stamps, written under UTC."""
    path = tempfile.mkdtemp(prefix="reshift-zone-") + "/usage"
    usage, _ = load_test_inputs(spark, SF_SMALL)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    usage.withColumns({c: F.col(c).cast("timestamp") for c in U.STAMPS}).write.parquet(path)
    yield path
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_session_zone_plays_no_part(spark, instants):
    _, reservations = load_test_inputs(spark, SF_SMALL)
    seen = []
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        st = Stages(load_usage(spark, instants), reservations, TEST_PARAMS)
        pushed = [ln for ln in explain(st.reserved_hourly).splitlines() if ln.startswith("PushedFilters")]
        assert "usagestartdate" in pushed[0] and "GreaterThanOrEqual" in pushed[0]
        seen.append((rows(st.window_filter), rows(st.reserved_hourly), rows(st.suggestions)))
    assert seen[0] == seen[1] == seen[2]
    assert len(seen[0][0]) == 407 and len(seen[0][1]) == 168


def test_run_zone_moves_the_window(spark, instants):
    there = RunParams(run_date="20240130", lookback_days=14, time_zone="Asia/Kolkata")
    got = U.window_filter(load_usage(spark, instants), there)
    bounds = got.agg(F.min("usagestartdate"), F.max("usagestartdate")).first()
    assert bounds[0] >= dt.datetime(2024, 1, 17) and bounds[1] < dt.datetime(2024, 1, 31)
    shifted = {r["usagestartdate"] for r in got.collect()}
    assert all(s.minute == 30 for s in shifted)


def test_hours_of_a_clock_change_stay_apart(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.sql("SELECT timestamp'2024-03-10 06:30:00Z' AS s, timestamp'2024-03-10 07:30:00Z' AS e")
    usage = usage_df(spark, [line()]).drop(*U.STAMPS).crossJoin(
        df.select(F.col("s").alias("usagestartdate"), F.col("e").alias("usageenddate")))
    params = RunParams(run_date="20240310", lookback_days=1, time_zone="America/New_York")
    # one hour long, though the wall clock goes from 01:30 to 03:30
    assert U.window_filter(usage, params).count() == 1


def test_malformed_text_is_dropped_and_counted(spark):
    good, path = line(), tempfile.mkdtemp(prefix="reshift-text-") + "/usage"
    texts = [("2024-01-30 10:00:00", "2024-01-30 11:00:00"), ("not-a-date", "2024-01-30 11:00:00"),
             (None, None), ("2024-01-30 10:00:00", "2024-13-40 11:00:00"), ("2023-01-01 10:00:00", "2023-01-01 11:00:00")]
    usage_df(spark, [good] * len(texts)).drop(*U.STAMPS).withColumn("n", F.monotonically_increasing_id()) \
        .limit(1).drop("n").crossJoin(spark.createDataFrame(texts, "usagestartdate string, usageenddate string")) \
        .write.parquet(path)
    usage = load_usage(spark, path)
    kept = U.window_filter(usage, TEST_PARAMS)
    assert [r["usagestartdate"] for r in kept.collect()] == [dt.datetime(2024, 1, 30, 10)]
    assert U.malformed_lines(usage).first()["n"] == 2
    pushed = [ln for ln in explain(kept).splitlines() if ln.startswith("PushedFilters")]
    assert "GreaterThanOrEqual(usagestartdate,2024-01-17)" in pushed[0]


def test_sums_do_not_depend_on_partitioning(spark):
    usage, reservations = load_test_inputs(spark, SF_SMALL)
    prices = usage.withColumn("unblendedcost", F.col("unblendedcost") * 0.0116 + 0.1)
    seen = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "8", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        st = Stages(prices.repartition(int(n)), reservations, TEST_PARAMS)
        seen.append((rows(st.ondemand_window), rows(st.suggestions), rows(st.reservation_shift)))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2] and len(seen[0][1]) > 30


def test_own_cpu_rules(spark):
    usage, reservations = load_test_inputs(spark, SF_SMALL)
    params = RunParams(run_date="20240130", cpu_rules=[["type", "m3.large", 7]])
    st = Stages(usage, reservations, params)
    assert {r["instancetype"]: r["cpu"] for r in st.cpu_weight.collect()}["m3.large"] == 7
    moves = st.candidate_moves.where("instancetype = 'm3.large'")
    assert {r["unused_instance_cpu"] for r in moves.collect()} == {7}


def test_cpu_weight_reads_the_window_only(spark):
    path = tempfile.mkdtemp(prefix="reshift-cpu-") + "/usage"
    usage, reservations = load_test_inputs(spark, SF_SMALL)
    usage.write.parquet(path)
    plan = explain(Stages(load_usage(spark, path), reservations, TEST_PARAMS).cpu_weight)
    assert any("usagestartdate" in ln for ln in plan.splitlines() if ln.startswith("PushedFilters"))


def test_idle_pools(spark):
    usage = usage_df(spark, [line(), line(purchaseoption="on-demand", instancetype="m3.xlarge", usagequantity=8.0)])
    reservations = reservations_df(spark, [reservation("ri-1", 4), reservation("ri-2", 6, instance_type="m3.xlarge"),
                                           reservation("ri-3", 0, instance_type="m3.medium")])
    plain = Stages(usage, reservations, RunParams(run_date="20240130"))
    idle = Stages(usage, reservations, RunParams(run_date="20240130", include_idle_pools=True))
    assert [r["instancetype"] for r in plain.unused_window.collect()] == ["m3.large"]
    found = {r["instancetype"]: r for r in idle.unused_window.collect()}
    assert set(found) == {"m3.large", "m3.xlarge"}
    assert found["m3.xlarge"]["unused_ritotal"] == 6 * 14 * 24 and found["m3.xlarge"]["non_usage_hr_prop_month"] == 100
    assert any(r["instancetype"] == "m3.xlarge" for r in idle.candidate_moves.collect())


def test_pool_match_has_no_residual_condition(spark):
    plan = explain(stages_for(spark, SF_SMALL).pool_match)
    joins = [ln for ln in plan.splitlines() if ln.startswith("Join condition")]
    assert joins and all(ln.endswith("None") for ln in joins)


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_MEDIUM, "/root/testdata/sf0.1"])
def test_fixtures_exercise_the_rules(spark, sf_dir):
    """Clamp, cutoff, cap and regional relabel have an effect at every scale factor."""
    st = stages_for(spark, sf_dir)
    balance = st.hourly_balance.agg(F.count_if(F.col("active") < F.col("consumption")).alias("n")).first()["n"]
    assert balance > 0
    assert 0 < st.high_unused.count() < st.unused_window.count()
    picks = st.picks.cache()
    assert picks.where("region = availability_zone").count() > 0
    demand = ["region", "os", "availabilityzone", "ondemand_instancetype"]
    served = picks.select(*[F.col(c).alias(f"p_{c}") for c in demand]).distinct()
    left = st.candidate_moves.join(served, [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in demand], "left_anti")
    assert left.where("instances_tobe_shifted < avg_unused_instances").count() > 0  # refused by the cap
    assert st.candidate_moves.where("avg_ondemand_cpu_needed > avg_unused_cpu_available").count() > 0
    picks.unpersist()
    if sf_dir != SF_SMALL:
        kinds = {r["instancetype"] for r in st.cpu_weight.collect()}
        assert {"m4.10xlarge", "x1.32xlarge", "t2.nano", "t2.medium", "m1.medium", "r5a.xlarge"} <= kinds
