"""The package must work when executors cannot import it (other working
directory, nothing installed): worker-side functions are pickled by value."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
from cabmeter.functions.quantiles import quantiles
from cabmeter.operators.outliers import top_n_per_group
df = spark.range(1001).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
print("Q", quantiles(df, "v", [0.5]).collect()[0][0])
print("T", top_n_per_group(df, "g", F.col("v"), 2).count())
"""


def test_runs_from_other_directory():
    cwd = tempfile.mkdtemp(prefix="cabmeter-deploy-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=300)
    assert "Q 500.0" in out.stdout, out.stderr[-2000:]
    assert "T 4" in out.stdout, out.stderr[-2000:]
