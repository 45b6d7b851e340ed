"""Unions of tagged tables and their rollups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An issue affecting more records than the bound gets the level.
SEVERITY_BANDS = [(100, "HIGH"), (10, "MEDIUM")]
SEVERITY_FLOOR = "LOW"


def union_tagged(frames: dict[str, DataFrame], columns: list[str], tag: str) -> DataFrame:
    """Union by name (all rows kept), each row tagged with the name of its table."""
    tagged = [df.select(F.lit(name).alias(tag), *columns) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged)


def severity(count: Column) -> Column:
    level = F.lit(SEVERITY_FLOOR)
    for bound, name in reversed(SEVERITY_BANDS):
        level = F.when(count > bound, F.lit(name)).otherwise(level)
    return level


def dq_rollup(quarantines: dict[str, DataFrame]) -> DataFrame:
    """Affected records and severity per (table, reason).

    Each quarantine table is counted before the union, so what is shuffled is one
    row per task and reason even when one reason holds most rows.
    """
    counted = {
        name: df.groupBy("error_reason").agg(F.count(F.lit(1)).alias("affected_records"))
        for name, df in quarantines.items()
    }
    issues = union_tagged(counted, ["error_reason", "affected_records"], "table_name")
    return issues.withColumnRenamed("error_reason", "rule_name").withColumn(
        "severity", severity(F.col("affected_records"))
    )
