"""The operators run on executors that have no copy of the package."""

import os
import subprocess
import sys

CODE = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("OFF")

def can_import(it):
    import importlib.util
    import pyarrow as pa
    list(it)
    yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("pickwise") is not None])], ["x"])

sys.path.insert(0, sys.argv[1])  # the driver alone finds the package
assert not any(r.x for r in spark.range(4).mapInArrow(can_import, "x boolean").collect())
from pickwise.llm.queries import QUERIES
for name, query in QUERIES.items():
    print(name, query(spark, sys.argv[2]).count())
"""


def test_tasks_need_no_installed_package(tmp_path, sf_small):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", CODE, repo, sf_small], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    lines = [x for x in said.stdout.splitlines() if x.startswith("op")]
    assert said.returncode == 0 and len(lines) == 13, said.stdout + said.stderr[-3000:]
