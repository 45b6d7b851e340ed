"""The run log of a step that fails after some batches."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lakeward.streaming import steps


def test_batches_before_the_failing_one_are_logged(spark, tmp_path):
    landing, log, out = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "out")
    landing.mkdir()
    for n, (name, text) in enumerate([("a.txt", "1\n2\n"), ("b.txt", "bad\n")]):
        (landing / name).write_text(text)
        os.utime(landing / name, (1_000_000 + n * 1000,) * 2)

    def build(s):
        lines = s.readStream.option("maxFilesPerTrigger", 1).text(str(landing))
        bad = F.when(F.col("value") == "bad", F.raise_error(F.lit("no")).cast("string"))
        return lines.select(F.coalesce(bad, "value").alias("value"))

    with pytest.raises(Exception):
        steps.run_steps(spark, [steps.Step("late", build, out)], str(tmp_path / "ck"), log)
    assert sorted(r["value"] for r in spark.read.parquet(out).collect()) == ["1", "2"]
    found = [json.loads(r["details"])["flow_progress"] for r in spark.read.parquet(log).collect()]
    done = [x["metrics"]["num_output_rows"] for x in found if x["status"] == "COMPLETED"]
    assert done == [2] and [x["status"] for x in found].count("FAILED") == 1
