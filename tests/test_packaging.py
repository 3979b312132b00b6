"""The workers find the package whatever the working directory."""

import os
import subprocess
import sys

JOB = """
from millrace.session import build_session
import millrace.plans as plans
from millrace.plans.registry import QUERIES
plans.load_all()
spark = build_session("elsewhere", "local[2]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4"})
print("ROWS", QUERIES["k14_daily_capacity"](spark, "%s").count())
"""


PLAIN = """
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("__spark_entry__", %r)
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
print("ROWS", entry.queries()["k14_daily_capacity"](spark, %r).count())
"""


def test_plain_session_from_another_folder(folder, tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = PLAIN % (os.path.join(root, "__spark_entry__.py"), folder)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "ROWS 6" in done.stdout, done.stderr[-2000:]


def test_other_folder(folder, tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # Only the driver knows the path; the workers get the package from the session.
    code = f"import sys; sys.path.insert(0, {root!r})" + JOB % folder
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "ROWS 6" in done.stdout, done.stderr[-2000:]
