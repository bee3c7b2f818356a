"""Write PLANS.md: the physical plan of every query key over Parquet inputs.

The fixture inputs are first written as plain Parquet tables (as production
inputs would be), so scans show what reaches the reader. Each entry is the
final adaptive plan after execution (tree only) plus the scan lines.

Usage: python tools/plans.py [sf_dir] [out.md]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reshift.plans.queries import QUERY_KEYS, TEST_PARAMS  # noqa: E402
from reshift.plans.stages import Stages  # noqa: E402
from reshift.session import local_session  # noqa: E402
from reshift.sources.tables import load_reservations, load_test_inputs, load_usage  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = local_session()
    base = tempfile.mkdtemp(prefix="reshift-plans-")
    usage, reservations = load_test_inputs(spark, sf_dir)
    usage.write.parquet(f"{base}/usage")
    reservations.write.parquet(f"{base}/reservations")
    lines = [
        "# Physical plans",
        "",
        f"Generated by `python tools/plans.py` from the fixtures of `{sf_dir}` written as Parquet",
        "tables, `local[8]`, AQE on. Each entry is the final adaptive plan after execution (the",
        "tree), followed by the scan lines of the formatted plan.",
        "",
    ]
    summary = ["| key | shuffles | broadcasts | Parquet scans | streamed folds |", "| --- | --- | --- | --- | --- |"]
    sections = []
    for key in (*QUERY_KEYS, "unused_rollups", "walk_candidates"):
        st = Stages(load_usage(spark, f"{base}/usage"),
                    load_reservations(spark, f"{base}/reservations"), TEST_PARAMS)
        df = getattr(st, key)
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n\n")[0].replace("== Physical Plan ==\n", "")
        if "+- == Initial Plan ==" in tree:
            tree = tree.split("+- == Initial Plan ==")[0].rstrip()
        scans = [ln for ln in text.splitlines()
                 if ln.startswith(("PushedFilters", "PartitionFilters", "ReadSchema"))]
        nodes = [ln.strip(" :|+-*") for ln in tree.splitlines()]
        shuffles = sum(1 for n in nodes if n.startswith("Exchange") or n.startswith("ReusedExchange"))
        broadcasts = sum(1 for n in nodes if n.startswith("BroadcastExchange"))
        scans_n = sum(1 for n in nodes if n.startswith("Scan parquet"))
        folds = sum(1 for n in nodes if n.startswith("MapInArrow"))
        summary.append(f"| `{key}` | {shuffles} | {broadcasts} | {scans_n} | {folds} |")
        sections += [f"## `{key}`", "", "```", tree.rstrip(), "", *scans, "```", ""]
    lines += ["Per key, in the final plan (a reused exchange counts as a shuffle it reads):", "",
              *summary, ""] + sections
    with open(out, "w") as fh:
        fh.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
