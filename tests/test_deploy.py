"""Python steps run where the workers cannot import the package by themselves."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import importlib.util, sys
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("contract", {entry!r})
contract = importlib.util.module_from_spec(spec)
spec.loader.exec_module(contract)
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {scratch!r}).getOrCreate())
print("ROWS", contract.queries()[{name!r}](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize(("name", "rows"), [("traffic_forecast", 480), ("service_anomalies_iforest", 20)])
def test_from_a_foreign_folder(tmp_path, name, rows):
    script = SCRIPT.format(entry=f"{REPO}/__spark_entry__.py", scratch=str(tmp_path / "scratch"), name=name)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert f"ROWS {rows}" in done.stdout, done.stderr[-2000:]
