"""Full run: both outputs, date-partition overwrite, idempotent re-run."""

import tempfile

from reshift import RunParams, run
from reshift.plans.queries import TEST_PARAMS, queries
from reshift.sources.sinks import SHIFT_COLUMNS, SUGGESTION_COLUMNS
from reshift.sources.tables import load_test_inputs
from tests.conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_run_writes_partitions_and_reruns_idempotently(spark):
    out = tempfile.mkdtemp(prefix="reshift-run-")
    sug_path, shift_path = f"{out}/suggestions", f"{out}/shifts"
    usage, reservations = load_test_inputs(spark, SF_SMALL)

    other = RunParams(run_date="20240125", lookback_days=14)
    run(usage, reservations, other, suggestions_target=sug_path, shifts_target=shift_path)
    before_other = rows(spark.read.parquet(sug_path).filter("dt = '20240125'"))

    for _ in range(2):  # second run of the same date replaces, never appends
        result = run(usage, reservations, TEST_PARAMS,
                     suggestions_target=sug_path, shifts_target=shift_path)
    written = spark.read.parquet(sug_path)
    assert rows(written.filter("dt = '20240130'").select(*SUGGESTION_COLUMNS)) == \
        rows(queries()["suggestions"](spark, SF_SMALL))
    assert rows(written.filter("dt = '20240125'")) == before_other
    shifts = spark.read.parquet(shift_path).filter("dt = '20240130'").select(*SHIFT_COLUMNS)
    assert rows(shifts) == rows(queries()["reservation_shift"](spark, SF_SMALL))
    assert shifts.count() == 41
    assert result.suggestions.count() == 43


def test_insert_into_partitioned_catalog_table(spark):
    from reshift.sources.sinks import write_suggestions

    loc = tempfile.mkdtemp(prefix="reshift-table-")
    spark.sql("DROP TABLE IF EXISTS reshift_suggestions_t")
    spark.sql(f"""CREATE TABLE reshift_suggestions_t (
        productname string, region string, unused_ri_availabilityzone string, os string,
        unused_ri_instancetype string, avg_unused_instances double,
        ondemand_availabilityzone string, ondemand_instancetype string,
        avg_ondemand_instances double, instances_tobe_shifted double,
        ondemand_instances_increased double, savings double, dt string)
        USING parquet PARTITIONED BY (dt) LOCATION '{loc}'""")
    sug = queries()["suggestions"](spark, SF_SMALL)
    write_suggestions(sug, "reshift_suggestions_t", "20240125")
    write_suggestions(sug, "reshift_suggestions_t", "20240130")
    write_suggestions(sug, "reshift_suggestions_t", "20240130")
    counts = {r["dt"]: r["n"] for r in
              spark.sql("SELECT dt, count(*) AS n FROM reshift_suggestions_t GROUP BY dt").collect()}
    assert counts == {"20240125": 43, "20240130": 43}
    write_suggestions(sug.limit(0), "reshift_suggestions_t", "20240130")
    left = spark.sql("SELECT count(*) AS n FROM reshift_suggestions_t WHERE dt = '20240130'").first()["n"]
    assert left == 0
    spark.sql("DROP TABLE reshift_suggestions_t")


def test_command_line_run(spark):
    from reshift.cli import main

    base = tempfile.mkdtemp(prefix="reshift-cli-")
    usage, reservations = load_test_inputs(spark, SF_SMALL)
    usage.write.parquet(f"{base}/usage")
    reservations.write.parquet(f"{base}/reservations")
    main(["--run-date", "20240130", "--usage", f"{base}/usage",
          "--reservations", f"{base}/reservations",
          "--suggestions-target", f"{base}/out/suggestions",
          "--shifts-target", f"{base}/out/shifts"], spark=spark)
    assert spark.read.parquet(f"{base}/out/suggestions").count() == 43
    assert spark.read.parquet(f"{base}/out/shifts").count() == 41


def test_empty_usage_gives_empty_outputs(spark):
    from tests.rows import reservation, reservations_df, usage_df

    result = run(usage_df(spark, []), reservations_df(spark, [reservation("ri-1", 3)]),
                 TEST_PARAMS, cut_lineage=False)
    assert result.suggestions.count() == 0 and result.shifts.count() == 0
    assert list(result.suggestions.columns) == list(SUGGESTION_COLUMNS)
    assert list(result.shifts.columns) == list(SHIFT_COLUMNS)


def test_rerun_with_empty_result_clears_its_partition(spark):
    from reshift.sources.sinks import write_suggestions

    out = tempfile.mkdtemp(prefix="reshift-empty-") + "/suggestions"
    sug = queries()["suggestions"](spark, SF_SMALL)
    write_suggestions(sug, out, "20240125")
    write_suggestions(sug, out, "20240130")
    write_suggestions(sug.limit(0), out, "20240130")
    counts = {r["dt"]: r["count"] for r in spark.read.parquet(out).groupBy("dt").count().collect()}
    assert counts == {20240125: 43}


def test_run_without_checkpoint_folder_persists(spark, monkeypatch):
    import reshift.session as session

    monkeypatch.setattr(session, "checkpoint_dir", lambda _spark: None)
    usage, reservations = load_test_inputs(spark, SF_SMALL)
    result = run(usage, reservations, TEST_PARAMS)
    assert result.stages.picks.is_cached
    assert result.suggestions.count() == 43 and result.shifts.count() == 41
    for df in (result.stages.hourly_usage, result.stages.candidate_moves, result.stages.picks):
        df.unpersist()


def failing_rows(spark, columns):
    """Rows whose last partitions end with an error, after others have been written."""
    from pyspark.sql import functions as F

    good = spark.range(0, 400, 1, 8)
    value = F.when(F.col("id") < 350, F.col("id").cast("double")).otherwise(F.raise_error(F.lit("lost")).cast("double"))
    return good.select(*[value.alias(c) if c in ("savings",) else F.lit("x").alias(c) if c not in NUMBERS
                         else F.lit(1.0).alias(c) for c in columns])


NUMBERS = ("avg_unused_instances", "avg_ondemand_instances", "instances_tobe_shifted", "ondemand_instances_increased")


def test_a_failed_write_leaves_the_old_date(spark, monkeypatch):
    """Both while the result is computed and while its files are written."""
    import pytest

    from reshift.sources import sinks

    out = tempfile.mkdtemp(prefix="reshift-kill-") + "/suggestions"
    loc = tempfile.mkdtemp(prefix="reshift-kill-table-")
    spark.sql("DROP TABLE IF EXISTS reshift_kill_t")
    good = queries()["suggestions"](spark, SF_SMALL)
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in good.schema.fields)
    spark.sql(f"CREATE TABLE reshift_kill_t ({types}, dt string) USING parquet PARTITIONED BY (dt) LOCATION '{loc}'")
    for target in (out, "reshift_kill_t"):
        sinks.write_suggestions(good, target, "20240129")
        sinks.write_suggestions(good, target, "20240130")
    bad = failing_rows(spark, SUGGESTION_COLUMNS)

    def kept(target):
        read = spark.read.parquet(target) if "/" in target else spark.table(target)
        return {str(r["dt"]): r["count"] for r in read.groupBy("dt").count().collect()}

    class AtWrite:
        """A result that was computed, but is lost again when its files are written."""
        def __init__(self, df):
            self.df = df

        def __getattr__(self, name):
            return getattr(self.df, name)

        def select(self, *columns):
            return good.limit(1).withColumn("dt", F.lit("20240130")).select("dt") if columns == ("dt",) else self.df.select(*columns)

    from pyspark.sql import functions as F
    for target in (out, "reshift_kill_t"):
        with pytest.raises(Exception, match="lost"):
            sinks.write_suggestions(bad, target, "20240130")
        assert kept(target) == {"20240129": 43, "20240130": 43}
        monkeypatch.setattr(sinks, "materialize", AtWrite)
        with pytest.raises(Exception, match="lost"):
            sinks.write_suggestions(bad, target, "20240130")
        monkeypatch.undo()
        assert kept(target) == {"20240129": 43, "20240130": 43}
        sinks.write_suggestions(good.limit(5), target, "20240130")
        assert kept(target) == {"20240129": 43, "20240130": 5}
    assert spark.conf.get(sinks.OVERWRITE_MODE).lower() == "static"
    spark.sql("DROP TABLE reshift_kill_t")


def test_rows_of_another_date_are_refused(spark):
    import pytest
    from pyspark.sql import functions as F

    from reshift.sources.sinks import write_partitions

    out = tempfile.mkdtemp(prefix="reshift-dates-") + "/t"
    df = spark.range(4).withColumn("dt", F.when(F.col("id") < 3, "20240101").otherwise("20240102"))
    with pytest.raises(ValueError, match="20240102"):
        write_partitions(df, out, ["20240101"], ["id"])
    write_partitions(df, out, ["20240101", "20240102", "20240103"], ["id"])
    assert {r["dt"]: r["count"] for r in spark.read.parquet(out).groupBy("dt").count().collect()} == {20240101: 3, 20240102: 1}
    with pytest.raises(ValueError, match="alphanumeric"):
        write_partitions(df, out, ["2024-01-01"], ["id"])
