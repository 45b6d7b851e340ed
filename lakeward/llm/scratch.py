"""Stored intermediate tables, and settings for work that passes through Python."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from lakeward.session import tune
from lakeward.sources.tables import shared_folder

# Bytes of one batch handed to a Python worker; rows are cut by bytes, not only by number.
BATCH_BYTES = "8m"
ROWS_PER_TASK = 100_000


def prepare(spark: SparkSession) -> SparkSession:
    """Adaptive plans with splitting of hot keys, and Arrow batches of bounded bytes.

    Python workers also look for this package where the driver found it; on a cluster it is
    installed or sent along as for any job.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        joined = os.pathsep.join([root, *filter(None, paths)])
        spark.sparkContext.environment["PYTHONPATH"] = joined
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return tune(spark)


def in_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in a task for every ``ROWS_PER_TASK`` of the ``rows`` it is made from, not in one for
    every partition of a shuffle, most of them nearly empty.
    """
    return df.coalesce(1 + rows // ROWS_PER_TASK)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the folder that the whole cluster shares and read it back.

    Lineage ends at the files, so a lost executor costs the repetition of one step.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
