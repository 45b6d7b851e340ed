"""Runtime settings the plans count on; every one can be overridden per session."""

from __future__ import annotations

import gc

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan with measured sizes; split hot join keys even when that costs a shuffle.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def release_shuffles(spark: SparkSession) -> None:
    """Delete the files of shuffles that no plan needs any more.

    Spark deletes them when the driver collects its garbage, which a driver that only waits for
    its executors rarely does: a run of several steps would keep the files of all of them.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
