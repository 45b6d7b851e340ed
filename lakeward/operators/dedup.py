"""Duplicate removal with a deterministic survivor.

``row_number() <= 1`` lets Spark place a group limit before the shuffle: every
task sends at most one row per group, so a group of copies that holds a third
of the table costs one row per task, not one overfull reducer.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _columns(names: str | Sequence[str | Column]) -> list[Column]:
    names = [names] if isinstance(names, str) else names
    return [F.col(n) if isinstance(n, str) else n for n in names]


def top_n_per_group(
    df: DataFrame, keys: str | Sequence[str | Column], order_by: Sequence[Column], n: int
) -> DataFrame:
    window = Window.partitionBy(*_columns(keys)).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n)


def one_per_key(
    df: DataFrame, keys: str | Sequence[str | Column], order_by: Sequence[Column]
) -> DataFrame:
    """First row of every key in the given order."""
    return top_n_per_group(df, keys, order_by, 1).drop("_rank")


def dedup_within(
    df: DataFrame, columns: Sequence[str | Column], order_by: str | Sequence[str | Column]
) -> DataFrame:
    """One row per distinct combination (nulls equal), the one with the smallest order value.

    For wide text pass a digest, such as ``sha2(text, 256)``, instead of the text:
    then only the digest and the columns still needed are shuffled.
    """
    return one_per_key(df, columns, [c.asc() for c in _columns(order_by)])


def dedup_against(new: DataFrame, existing: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``new`` with no equal row in ``existing``; nulls compare as equal.

    ``existing`` is a snapshot handed in by the caller, never the table being written.
    """
    seen = existing.select(*[F.col(c).alias(f"_seen_{c}") for c in columns])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_seen_{c}")) for c in columns])
    return new.join(seen, same, "left_anti")


def first_version_wins(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet: a stored version is never replaced."""
    return dedup_against(new, existing, [key])


def upsert(old: DataFrame, new: DataFrame, key: str, order_by: Sequence[Column]) -> DataFrame:
    """Full snapshot with the latest row per key after adding ``new`` to ``old``."""
    merged = old.unionByName(new, allowMissingColumns=True).where(F.col(key).isNotNull())
    return one_per_key(merged, key, order_by)
