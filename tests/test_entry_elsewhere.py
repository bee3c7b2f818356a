"""The driver contract from another working directory, in a fresh default session.

The driver finds the package through its own sys.path only; the Python
workers must still run the greedy walk (it is pickled by value).
"""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util, sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
sys.path.insert(0, {REPO!r})
spec = importlib.util.spec_from_file_location("entry_mod", {os.path.join(REPO, '__spark_entry__.py')!r})
mod = importlib.util.module_from_spec(spec)
spec.loader.exec_module(mod)
print("ROWS", mod.entry(spark).count(), mod.queries()["reservation_shift"](spark, "/root/testdata/sf0.001").count())
"""


def test_entry_runs_from_another_directory():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(prefix="reshift-cwd-"),
                         env=env, capture_output=True, text=True, timeout=600)
    assert "ROWS 43 41" in out.stdout, out.stderr[-3000:]
