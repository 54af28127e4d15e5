"""The driver contract in a plain session started outside the repository: the executors'
Python workers must still import the package (the alert stream's pandas state function)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").getOrCreate())
import __spark_entry__ as E
assert E.entry(spark).count() > 0
n = E.queries()["q_stream_latency_alerts"](spark, "/root/testdata/sf0.001").count()
print("ROWS", n)
"""


def test_entry_and_python_worker_query_from_another_directory():
    with tempfile.TemporaryDirectory() as cwd:
        out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "ROWS " in out.stdout and int(out.stdout.split("ROWS ")[1].split()[0]) > 0
