from __future__ import annotations

import subprocess
import sys
import tempfile

from conftest import ROOT

CODE = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__
row = __spark_entry__.queries()["order_layout_as_read"](spark, "/root/testdata/sf0.001").first()
assert row.ids_run_on and row.rows == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
"""


def test_workers_find_the_package_from_any_folder():
    """In a process of its own, started elsewhere, with the package on the driver's path only."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    done = subprocess.run([sys.executable, "-c", CODE], cwd=folder, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
