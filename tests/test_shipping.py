"""Queries with Python workers, started from a folder that has no package."""

import os
import subprocess
import sys


REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", 2).config("spark.checkpoint.dir", {shared!r}).getOrCreate()
print(len(entry.queries()["file_hashes"](spark, "/root/testdata/sf0.001").collect()))
"""


def test_workers_find_the_package(tmp_path):
    given = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(repo=REPO, shared=str(tmp_path / "shared"))
    found = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=given, capture_output=True, text=True, timeout=300)
    assert found.returncode == 0, found.stderr[-2000:]
    assert int(found.stdout.split()[-1]) > 10
