"""Benchmark: every query key plus the full run, at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` sink (all rows are
produced, nothing is collected). One warm-up pass, then the median of
$BENCH_REPEAT timed runs per query. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reshift.params import RunParams  # noqa: E402
from reshift.plans.job import run  # noqa: E402
from reshift.plans.queries import QUERY_KEYS, TEST_PARAMS, queries  # noqa: E402
from reshift.session import local_session  # noqa: E402
from reshift.sources.tables import load_test_inputs  # noqa: E402


def _drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _full_run(spark, sf_dir: str, params: RunParams) -> None:
    usage, reservations = load_test_inputs(spark, sf_dir)
    result = run(usage, reservations, params)
    _drain(result.suggestions)
    _drain(result.shifts)
    for df in (result.stages.hourly_usage, result.stages.picks):
        df.unpersist()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="reshift-bench")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        # a single machine: BENCH_CHECKPOINT_DIR, else a scratch folder
        folder = os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="reshift-bench-ckpt-")
        spark.sparkContext.setCheckpointDir(folder)

    registry = queries()
    jobs = {key: (lambda k=key: _drain(registry[k](spark, sf_dir))) for key in QUERY_KEYS}
    jobs["full_run"] = lambda: _full_run(spark, sf_dir, TEST_PARAMS)

    for fn in jobs.values():  # warm-up
        fn()
    timings, spread = {}, {}
    for key, fn in jobs.items():
        samples = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn()
            samples.append(time.perf_counter() - t0)
        timings[key] = round(statistics.median(samples), 3)
        spread[key] = [round(min(samples), 3), round(max(samples), 3)]

    # output rows per key (one untimed count each), to show the work is whole
    rows = {key: registry[key](spark, sf_dir).count() for key in QUERY_KEYS}

    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({
        "metric": "sum of median query seconds (16 stage queries + full run)",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "spread": spread,
        "rows": rows,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
