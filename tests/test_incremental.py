"""Hourly usage kept between runs: equal results, and only new or changed dates are scanned."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from reshift import RunParams, run
from reshift.operators.usage import hourly_usage
from reshift.sources.hourly_store import HourlyStore
from reshift.sources.tables import load_test_inputs, load_usage
from tests.conftest import SF_SMALL


def params(date, **more):
    return RunParams(run_date=date, lookback_days=7, usage_partition_column="dt", usage_partition_format="%Y%m%d", **more)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def source(spark):
    path = tempfile.mkdtemp(prefix="reshift-hours-") + "/usage"
    usage, _ = load_test_inputs(spark, SF_SMALL)
    (usage.withColumn("dt", F.date_format("usagestartdate", "yyyyMMdd")).repartition(2)
     .write.partitionBy("dt").parquet(path))
    return path


def whole(spark, path, p):
    return rows(hourly_usage(spark.read.parquet(path), p))


def emptied(spark, path, date):
    none = spark.read.parquet(path).drop("dt").limit(0)
    none.write.mode("overwrite").parquet(f"{path}/dt={date}")


def days(*numbers):
    return [dt.date(2024, 1, n) for n in numbers]


def test_only_new_and_changed_dates_are_scanned(spark, source):
    folder = tempfile.mkdtemp(prefix="reshift-store-")
    first = HourlyStore(spark, source, folder, params("20240120"))
    assert first.refresh() == days(*range(14, 21))
    assert rows(first.hourly()) == whole(spark, source, params("20240120"))
    assert first.refresh() == []

    # a run three days later: three new dates, and the one whose margin lay beyond the first window was whole already
    later = HourlyStore(spark, source, folder, params("20240123"))
    assert later.refresh() == days(21, 22, 23)
    assert rows(later.hourly()) == whole(spark, source, params("20240123"))

    # a late line filed under the 19th may belong to the days beside it
    late = spark.read.parquet(source).where("dt = 20240119 AND purchaseoption = 'on-demand'").limit(3).drop("dt")
    late.write.mode("append").parquet(f"{source}/dt=20240119")
    assert later.refresh() == days(18, 19, 20)
    assert rows(later.hourly()) == whole(spark, source, params("20240123"))
    assert later.refresh() == []


def test_gaps_and_deleted_dates(spark, source):
    emptied(spark, source, "20240117")
    folder = tempfile.mkdtemp(prefix="reshift-store-")
    store = HourlyStore(spark, source, folder, params("20240120"))
    assert store.refresh() == days(*range(14, 21))
    kept = rows(store.hourly())
    assert kept == whole(spark, source, params("20240120")) and not [r for r in kept if r[4] == 17]
    emptied(spark, source, "20240115")
    assert store.refresh() == days(14, 15, 16)
    again = rows(store.hourly())
    assert again == whole(spark, source, params("20240120")) and not [r for r in again if r[4] == 15]
    assert store.refresh() == []


def test_a_run_that_ends_before_the_ledger_is_done_again(spark, source, monkeypatch):
    folder = tempfile.mkdtemp(prefix="reshift-store-")
    store = HourlyStore(spark, source, folder, params("20240120"))
    replace = HourlyStore._replace

    def stop(self, frame, name):
        if name == "ledger":
            raise RuntimeError("killed")
        replace(self, frame, name)

    monkeypatch.setattr(HourlyStore, "_replace", stop)
    with pytest.raises(RuntimeError):
        store.refresh()
    monkeypatch.undo()
    assert store.refresh() == days(*range(14, 21))
    assert rows(store.hourly()) == whole(spark, source, params("20240120"))


def test_stores_of_other_zones_do_not_meet(spark, source):
    folder = tempfile.mkdtemp(prefix="reshift-store-")
    assert HourlyStore(spark, source, folder, params("20240120")).refresh()
    other = HourlyStore(spark, source, folder, params("20240120", time_zone="Asia/Tokyo"))
    assert other.refresh() == days(*range(14, 21))
    with pytest.raises(ValueError, match="usage_partition_column"):
        HourlyStore(spark, source, folder, RunParams(run_date="20240120"))


def test_runs_over_the_store_equal_plain_runs(spark, source):
    _, reservations = load_test_inputs(spark, SF_SMALL)
    folder = tempfile.mkdtemp(prefix="reshift-store-")
    out = tempfile.mkdtemp(prefix="reshift-rollups-") + "/pools"
    for date in ("20240122", "20240130"):
        p = params(date)
        plain = run(load_usage(spark, source), reservations, RunParams(run_date=date, lookback_days=7))
        kept = run(spark.read.parquet(source), reservations, p, rollups_target=out,
                   hourly=HourlyStore(spark, source, folder, p).hourly())
        assert rows(kept.suggestions) == rows(plain.suggestions)
        assert rows(kept.shifts) == rows(plain.shifts)
        written = spark.read.parquet(out).where(F.col("dt") == date)
        window = [c for c in written.columns if c not in ("days", "dt")]
        assert rows(written.select(*window)) == rows(plain.stages.unused_window.select(*window))
        assert written.select(F.explode("days")).count() == plain.stages.unused_daily.count()


def test_registered_table_is_read_by_name(spark, source):
    spark.sql("DROP TABLE IF EXISTS reshift_lines_t")
    spark.sql(f"CREATE TABLE reshift_lines_t USING parquet LOCATION '{source}'")
    spark.sql("MSCK REPAIR TABLE reshift_lines_t")
    folder = tempfile.mkdtemp(prefix="reshift-store-")
    store = HourlyStore(spark, "reshift_lines_t", folder, params("20240120"))
    assert rows(store.hourly()) == whole(spark, source, params("20240120"))
    spark.sql("DROP TABLE reshift_lines_t")
