"""Task retries (a lost executor) neither lose nor double-count rows.

Runs in its own Spark process: ``local[4,3]`` allows three attempts per
task, which the shared test session (one attempt) does not. The first
attempt of one write-stage task fails after rows have already passed the
row-count observation; the retry must give the same count and files.
"""

from __future__ import annotations

import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = r"""
import json, sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import Observation, functions as F
from marquee.operators.sinks import write_partitioned
from marquee.session import build_session, scratch_path

spark = build_session("local[4,3]", shuffle_partitions=4)

@F.udf("long")
def fail_first_attempt(v):
    ctx = TaskContext.get()
    # one write-stage task, first attempt, after ~1000 of its rows
    if ctx.attemptNumber() == 0 and ctx.partitionId() == 0 \
            and v % 1000 == 999:
        raise RuntimeError("injected task failure")
    return v

rows = 40_000
df = spark.range(rows).selectExpr("id", "CAST(id % 3 AS STRING) AS part")
path = scratch_path(spark, "retry")
obs = Observation("rows_written")
# The sort key is evaluated in the write stage, after the observation.
write_partitioned(df, path, ["part"], sort_by=[fail_first_attempt(F.col("id"))], observation=obs)
back = spark.read.parquet(path)
print(json.dumps({
    "observed": int(obs.get["rows"]),
    "read_back": back.count(),
    "distinct_ids": back.select("id").distinct().count(),
}))
spark.stop()
"""


def test_retried_write_task_counts_once(tmp_path):
    script = tmp_path / "retry.py"
    script.write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_SUBMIT")}
    out = subprocess.run(
        [sys.executable, str(script), str(ROOT)], capture_output=True, text=True,
        timeout=300, env=env,
    )
    assert out.returncode == 0, out.stderr[-3000:]
    assert "injected task failure" in out.stderr  # the failure did happen
    result = json.loads(out.stdout.strip().splitlines()[-1])
    assert result == {"observed": 40_000, "read_back": 40_000, "distinct_ids": 40_000}
