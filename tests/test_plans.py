"""Plan shape: pushdown and pruning at the scan, exchange reuse, one greedy walk."""

import contextlib
import io
import tempfile

from reshift.operators import usage as U
from reshift.plans.queries import TEST_PARAMS, stages_for
from reshift.sources.tables import load_test_inputs, load_usage
from tests.conftest import SF_SMALL


def explain(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_window_and_branch_reach_the_parquet_scan(spark):
    path = tempfile.mkdtemp(prefix="reshift-usage-") + "/usage"
    usage, _ = load_test_inputs(spark, SF_SMALL)
    usage.write.parquet(path)
    hourly = U.reserved_hourly(U.hourly_usage(load_usage(spark, path), TEST_PARAMS, (U.RESERVED,)))
    plan = explain(hourly)
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters")]
    assert pushed and "usagestartdate" in pushed[0] and "purchaseoption" in pushed[0]
    schema = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")][0]
    assert "itemdescription" not in schema and "measure" not in schema


def test_balance_chain_uses_one_exchange_after_the_hourly_aggregate(spark):
    st = stages_for(spark, SF_SMALL)
    plan = explain(st.unused_window)
    # hourly aggregate, inventory (two aggregates), pools, and one repartition
    assert plan.count("REPARTITION_BY_COL") == 1
    assert "BroadcastHashJoin" in plan


def test_two_streamed_folds_in_reservation_shift(spark):
    df = stages_for(spark, SF_SMALL).reservation_shift
    df.collect()
    final = explain(df, "simple").split("== Initial Plan ==")[0]
    # first fit, and the walk for its limits and its moves over one shuffle of the candidates; no group is held
    assert final.count("MapInArrow") == 3
    assert any("ReusedExchange" in ln and "family" in ln for ln in final.splitlines())
    assert "FlatMapGroupsInPandas" not in final and "FlatMapCoGroupsInPandas" not in final


def test_date_partitioned_usage_is_pruned_and_equal(spark):
    from reshift.params import RunParams
    from pyspark.sql import functions as F

    path = tempfile.mkdtemp(prefix="reshift-usage-dt-") + "/usage"
    usage, _ = load_test_inputs(spark, SF_SMALL)
    (usage.withColumn("dt", F.date_format("usagestartdate", "yyyyMMdd"))
          .write.partitionBy("dt").parquet(path))
    params = RunParams(run_date="20240130", lookback_days=14, usage_partition_column="dt",
                       usage_partition_format="%Y%m%d")
    table = spark.read.parquet(path)
    pruned = U.reserved_hourly(U.hourly_usage(table, params, (U.RESERVED,)))
    plan = explain(pruned)
    part = [ln for ln in plan.splitlines() if ln.startswith("PartitionFilters")]
    assert part and "dt" in part[0]
    plain = U.reserved_hourly(U.hourly_usage(load_usage(spark, path), TEST_PARAMS, (U.RESERVED,)))
    assert sorted(map(tuple, pruned.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    assert pruned.count() == 168


def test_string_and_session_zone_timestamps_give_the_same_hours(spark):
    from pyspark.sql import functions as F

    base = tempfile.mkdtemp(prefix="reshift-usage-types-")
    usage, _ = load_test_inputs(spark, SF_SMALL)
    usage.write.parquet(f"{base}/ntz")
    (usage.withColumn("usagestartdate", F.date_format("usagestartdate", "yyyy-MM-dd HH:mm:ss"))
          .withColumn("usageenddate", F.date_format("usageenddate", "yyyy-MM-dd HH:mm:ss"))
          .write.parquet(f"{base}/str"))
    (usage.withColumn("usagestartdate", F.col("usagestartdate").cast("timestamp"))
          .withColumn("usageenddate", F.col("usageenddate").cast("timestamp"))
          .write.parquet(f"{base}/ltz"))
    results = []
    for kind in ("ntz", "str", "ltz"):
        df = U.reserved_hourly(U.hourly_usage(load_usage(spark, f"{base}/{kind}"), TEST_PARAMS))
        results.append(sorted(map(tuple, df.collect()), key=repr))
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 168
    ltz = U.reserved_hourly(U.hourly_usage(load_usage(spark, f"{base}/ltz"), TEST_PARAMS, (U.RESERVED,)))
    pushed = [ln for ln in explain(ltz).splitlines() if ln.startswith("PushedFilters")]
    assert "usagestartdate" in pushed[0]


def test_run_reads_the_usage_lines_once(spark):
    from reshift.plans.job import run

    usage, reservations = load_test_inputs(spark, SF_SMALL)
    result = run(usage, reservations, TEST_PARAMS)
    # the hourly aggregate (one scan) is checkpointed before the outputs are planned
    for df in (result.suggestions, result.shifts):
        assert "events.parquet" not in explain(df)
    assert "events.parquet" not in explain(result.stages.candidate_moves)
