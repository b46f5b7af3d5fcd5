"""Queries run from any folder: the workers get the package from the driver."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent

RUN = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
print("ROWS", entry.queries()["smote_counts"](spark, "/root/testdata/sf0.001").count())
"""


def test_from_an_empty_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", RUN], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 3" in done.stdout, done.stderr[-2000:]
