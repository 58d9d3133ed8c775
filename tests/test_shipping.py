"""Workers run the operators without having the package."""

import os
import subprocess
import sys

SCRIPT = """
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", {entry!r})
module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(module)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
print("ROWS", module.queries()["framed_roundtrip"](spark, "/root/testdata/sf0.001").count())
"""


def test_tasks_carry_their_code(tmp_path):
    entry = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(entry=entry)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "ROWS 200" in run.stdout, run.stderr[-2000:]
