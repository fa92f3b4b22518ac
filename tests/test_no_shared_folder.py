"""Without spark.checkpoint.dir the library still answers correctly: checked
joins use a folder in the session's warehouse, and nothing is set on the
session.  Runs in a fresh process whose Spark config folder is empty."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.sparkContext.getCheckpointDir() is None
import __spark_entry__ as e
q = e.queries()
for n in ("fill_group_mean", "carriers_on_top_routes", "csv_roundtrip", "join_weather"):
    print(n, q[n](spark, "/root/testdata/sf0.001").count())
print("entry", e.entry(spark).count())
assert spark.sparkContext.getCheckpointDir() is None
"""


def test_queries_run_without_a_checkpoint_folder():
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="runway-noconf-"))
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, cwd=tempfile.mkdtemp(prefix="runway-cwd-"), capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    counts = dict(line.split() for line in out.stdout.strip().splitlines())
    assert int(counts["fill_group_mean"]) > 0 and int(counts["entry"]) > 0
    assert int(counts["csv_roundtrip"]) == int(counts["fill_group_mean"])
