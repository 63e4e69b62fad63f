"""User functions reach the workers although these cannot import the package."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry_points
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
for name in ("word_count_user_code", "stream_sliding_sum"):
    assert entry_points.queries()[name](spark, sys.argv[2]).count() > 0
spark.stop()
print("done")
"""


def test_runs_from_any_folder(tmp_path, data):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    result = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(ROOT), data], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180
    )
    assert result.stdout.strip().endswith("done"), result.stderr[-2000:]
