"""Executors that have no copy of the library."""

from __future__ import annotations

import os
import subprocess
import sys

from tests.llm.helpers import SF_DIR

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

JOB = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {shared!r}).getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
try:
    spark.range(1).rdd.map(lambda x: __import__("salesmart")).collect()
except Exception as missing:
    assert "ModuleNotFoundError" in str(missing)
else:
    raise SystemExit("the workers have the package")
from salesmart.llm.queries import QUERIES
for name in ("op1", "op4", "op5", "op7", "op8", "op9", "op10", "op12", "op13"):
    query = next(q for n, q in QUERIES.items() if n.startswith(name + "_"))
    print(name, len(query(spark, {sf_dir!r}).collect()))
"""


def test_jobs_need_no_package_on_the_workers(tmp_path):
    job = tmp_path / "job.py"
    job.write_text(JOB.format(repo=REPO, shared=str(tmp_path / "shared"), sf_dir=SF_DIR))
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYTHONPATH", "PYSPARK", "SPARK"))}
    done = subprocess.run([sys.executable, str(job)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    lines = [line.split() for line in done.stdout.splitlines() if line.startswith("op")]
    assert len(lines) == 9 and all(int(n) > 0 for _, n in lines)
