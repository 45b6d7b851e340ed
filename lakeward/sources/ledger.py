"""Which contents earlier loads have brought, by digest: loads are compared without their tables.

An entry is 32 bytes, whatever the width of the rows it stands for.  Entries lie in partitions by
load and by bucket of the digest, so a load reads the buckets of its own rows, and its own
entries, should it be run again, are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.sources.tables import LOAD, optional_path, write_load

BUCKETS = 256


def content_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """32 bytes that are equal for rows that agree in all ``columns``, nulls and NaN included.

    Every value goes in as text behind its length, null as a mark of its own; -0.0 equals 0.0,
    and times count as instants whatever the session's zone.
    """
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    parts = []
    for name in columns:
        value = F.col(f"`{name}`")
        if kinds[name] in ("double", "float"):
            value = value + F.lit(0).cast(kinds[name])
        elif kinds[name] == "timestamp":
            value = F.unix_micros(value)
        elif kinds[name] in ("array", "struct"):
            value = F.to_json(value, {"ignoreNullFields": "false"})
        text = value.cast("string")
        length = F.octet_length(text).cast("string")
        parts.append(F.coalesce(F.concat(length, F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _keyed(df: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    digest = df.withColumn("_digest", content_digest(df, columns))
    return digest.withColumn("_bucket", F.pmod(F.xxhash64("_digest"), F.lit(buckets)).cast("int"))


def unseen(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    load: int,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Rows of ``df`` whose content no load before ``load`` has entered at ``path``.

    The numbers of the buckets that occur, at most ``buckets``, reach the driver; the files of
    other buckets are not read.  Repeats inside ``df`` stay.
    """
    entries = optional_path(spark, path)
    if entries is None:
        return df
    keyed = _keyed(df, columns, buckets)
    own = [row[0] for row in keyed.select("_bucket").distinct().collect()]
    seen = entries.where((F.col(LOAD) < load) & F.col("_bucket").isin(own))
    new = keyed.join(seen.select("_bucket", "_digest"), ["_bucket", "_digest"], "left_anti")
    return new.select(*[F.col(f"`{c}`") for c in df.columns])


def enter(
    df: DataFrame, path: str, columns: Sequence[str], load: int, buckets: int = BUCKETS
) -> None:
    """Enter the contents of ``df`` under ``load``; entered again, they replace themselves."""
    rows = _keyed(df, columns, buckets).select("_bucket", "_digest").distinct()
    write_load(rows, path, load, ["_bucket"])
