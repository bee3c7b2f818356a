"""Command line: one scheduled run for one date, or a back-fill of several.

    spark-submit --py-files reshift.zip reshift/__main__.py \\
        --run-date 20240130 --lookback-days 14 --cutoff-pct 80 \\
        --usage usage_db.billing_lines --reservations inventory_db.reservations \\
        --suggestions-target out_db.move_suggestions --shifts-target out_db.reservation_shifts

(or ``python -m reshift ...``). Inputs and targets are catalog table names
or Parquet paths. The session is taken from the environment (``getOrCreate``),
so cluster settings, including ``spark.checkpoint.dir``, come from
spark-submit.
"""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import SparkSession

from reshift.functions.cpu import CPU_RULES
from reshift.operators.usage import malformed_lines
from reshift.params import RunParams
from reshift.plans.backfill import run_many
from reshift.plans.job import run
from reshift.sources.hourly_store import HourlyStore
from reshift.sources.tables import load_reservations, load_usage

log = logging.getLogger(__name__)


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="reshift", description=__doc__.split("\n")[0])
    when = p.add_mutually_exclusive_group(required=True)
    when.add_argument("--run-date", help="yyyyMMdd or yyyy-MM-dd; closes the window")
    when.add_argument("--run-dates", help="several of them, comma-separated: a back-fill in one job")
    p.add_argument("--lookback-days", type=int, default=14)
    p.add_argument("--cutoff-pct", type=float, default=80.0)
    p.add_argument("--allow-full-use", action="store_true",
                   help="let a pool give away its whole average unused count")
    p.add_argument("--usage", required=True, help="usage lines: table name or Parquet path")
    p.add_argument("--reservations", required=True, help="inventory: table name or Parquet path")
    p.add_argument("--usage-partition-column", default=None)
    p.add_argument("--usage-partition-format", default="%Y-%m-%d")
    p.add_argument("--usage-partition-margin-days", type=int, default=1)
    p.add_argument("--time-zone", default="UTC", help="zone whose wall clock the billing hours follow")
    p.add_argument("--include-idle-pools", action="store_true", help="also offer pools nobody used")
    p.add_argument("--reservation-order", choices=("id", "fewest"), default="id")
    p.add_argument("--cpu-rules", default=None, help="JSON list of [kind, value, weight], in order")
    p.add_argument("--cpu-rules-table", default=None, help="table of rules (kind, key, weight, rank)")
    p.add_argument("--salt-buckets", type=int, default=32,
                   help="salted slices per (pool, shift) in the first-fit pruning")
    p.add_argument("--suggestions-target", required=True)
    p.add_argument("--shifts-target", required=True)
    p.add_argument("--rollups-target", default=None, help="unused capacity of every pool, over the window and by day")
    p.add_argument("--hourly-store", default=None,
                   help="shared folder that keeps hourly usage, so that a run scans only new or changed dates")
    return p.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> None:
    args = parse_args(argv)
    dates = args.run_dates.split(",") if args.run_dates else [args.run_date]
    spark = spark or SparkSession.builder.appName(f"reshift-{dates[-1]}").getOrCreate()
    params = RunParams(run_date=dates[-1], lookback_days=args.lookback_days,
                       cutoff_pct=args.cutoff_pct, allow_full_use=args.allow_full_use,
                       usage_partition_column=args.usage_partition_column,
                       usage_partition_format=args.usage_partition_format,
                       usage_partition_margin_days=args.usage_partition_margin_days,
                       time_zone=args.time_zone, include_idle_pools=args.include_idle_pools,
                       reservation_order=args.reservation_order,
                       cpu_rules=json.loads(args.cpu_rules) if args.cpu_rules else CPU_RULES,
                       cpu_rules_table=args.cpu_rules_table,
                       first_fit_salt_buckets=args.salt_buckets)
    usage = load_usage(spark, args.usage, args.usage_partition_column)
    bad = malformed_lines(usage, params).first()
    if bad["n"]:
        log.warning("%d usage lines have malformed stamps and are left out", bad["n"])
    if bad["amounts"]:
        log.warning("%d usage lines have a quantity or cost that is no number; it is not counted", bad["amounts"])
    reservations = load_reservations(spark, args.reservations)
    if args.run_dates:
        if args.hourly_store or args.rollups_target:
            raise ValueError("a back-fill takes neither --hourly-store nor --rollups-target")
        run_many(usage, reservations, dates, params,
                 suggestions_target=args.suggestions_target, shifts_target=args.shifts_target)
        return
    hourly = HourlyStore(spark, args.usage, args.hourly_store, params).hourly() if args.hourly_store else None
    run(usage, reservations, params,
        suggestions_target=args.suggestions_target, shifts_target=args.shifts_target,
        rollups_target=args.rollups_target, hourly=hourly)
