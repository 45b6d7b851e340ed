"""Tables kept as whole versions, of which a pointer names the current one.

A version is a partition named by the load it was made for, and so is the pointer's entry, which
is written when the version is whole.  Readers see the old version or the new one.  A load that is
run again, after a failure or by mistake, starts from the version before it and replaces its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.sources.tables import LOAD, optional_path, write_load

POINTER = "_current"


def _pointer(path: str) -> str:
    return f"{path.rstrip('/')}{POINTER}"


def current(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The published version, or the last one published for a load ``before`` a given one."""
    entries = optional_path(spark, _pointer(path))
    if entries is None:
        return None
    if before is not None:
        entries = entries.where(F.col(LOAD) < before)
    load = entries.agg(F.max(LOAD)).first()[0]
    return None if load is None else spark.read.parquet(f"{path}/{LOAD}={load}")


def publish(df: DataFrame, path: str, load: int) -> None:
    """Write ``df`` as the version of ``load``, then make it the current one."""
    write_load(df, path, load)
    entry = df.sparkSession.range(1).select(F.current_timestamp().alias("published"))
    write_load(entry, _pointer(path), load)
