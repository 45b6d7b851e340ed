"""Versions of dimensions, the ledger of contents, and silver stored in one pass."""

import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeward.plans import star
from lakeward.plans.layers import Layers
from lakeward.sources import ledger, snapshots, tables

SF_DIR = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_readers_see_the_version_that_the_pointer_names(spark, tmp_path):
    path = str(tmp_path / "dim")
    assert snapshots.current(spark, path) is None
    snapshots.publish(spark.range(2), path, 1)
    tables.write_load(spark.range(9), path, 2)  # a version that was never published
    assert ids(snapshots.current(spark, path)) == [0, 1]
    snapshots.publish(snapshots.current(spark, path, before=2).union(spark.range(5, 6)), path, 2)
    assert ids(snapshots.current(spark, path)) == [0, 1, 5]
    assert ids(snapshots.current(spark, path, before=2)) == [0, 1]
    # The load is run again: it starts from version 1 and replaces version 2.
    snapshots.publish(snapshots.current(spark, path, before=2).union(spark.range(7, 8)), path, 2)
    assert ids(snapshots.current(spark, path)) == [0, 1, 7]


ROWS = [("a", 1.0, None), ("a", None, "x"), (None, -0.0, "1:a"), ("", math.nan, ""), ("1:a", 2.0, None)]
SCHEMA = "k string, v double, w string"


def test_the_ledger_finds_what_earlier_loads_brought(spark, tmp_path):
    path, columns = str(tmp_path / "ledger"), ["k", "v", "w"]
    first = spark.createDataFrame(ROWS, SCHEMA).withColumn("wide", F.lit("not compared"))
    assert ledger.unseen(spark, first, path, columns, 1).count() == 5
    ledger.enter(first, path, columns, 1)
    # Run again, a load does not find itself.
    assert ledger.unseen(spark, first, path, columns, 1).count() == 5
    new = [(None, 0.0, "1:a"), ("a", 1.0, ""), ("a1:", None, None), (None, None, None), (None, None, None)]
    second = spark.createDataFrame(ROWS + new, SCHEMA)
    found = ledger.unseen(spark, second, path, columns, 2)
    assert sorted(map(str, found.collect())) == sorted(
        f"Row(k={k!r}, v={v!r}, w={w!r})" for k, v, w in new[1:]
    )
    ledger.enter(found, path, columns, 2)
    assert ledger.unseen(spark, second, path, columns, 3).count() == 0
    assert spark.read.parquet(path).count() == 5 + 3


def test_the_ledger_reads_buckets_of_the_load_and_no_target(spark, tmp_path):
    path = str(tmp_path / "ledger")
    many = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    ledger.enter(many, path, ["k"], 1, buckets=64)
    few = spark.createDataFrame([("5",), ("x",)], "k string")
    found = ledger.unseen(spark, few, path, ["k"], 2, buckets=64)
    assert [r["k"] for r in found.collect()] == ["x"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_load_id" in plan and "_bucket" in plan
    read = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert all("struct<_digest:binary>" in line for line in read)


def test_times_count_as_instants(spark):
    rows = spark.sql("SELECT timestamp '2024-01-01 00:00:00.000001 UTC' AS t")
    digest = rows.select(ledger.content_digest(rows, ["t"])).first()[0]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert rows.select(ledger.content_digest(rows, ["t"])).first()[0] == digest
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not mounted")
def test_a_repeated_load_of_a_dimension_changes_nothing(spark):
    layers = Layers(spark, SF_DIR, fresh=True)
    before = layers.dimension("cars")
    assert star.LOADED in before.columns
    changed = before.limit(3).withColumns(
        {"name": F.lit("new"), star.LOADED: F.lit("2025-01-01").cast("timestamp")}
    )
    changed = spark.createDataFrame(changed.collect(), changed.schema)
    for _ in range(2):
        after = layers.load_dimension("cars", changed, 2)
        assert after.count() == before.count() and after.where("name = 'new'").count() == 3
    assert layers.dimension("cars").where("name = 'new'").count() == 3


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not mounted")
@pytest.mark.parametrize("name", ["cars", "policy"])
def test_the_stored_sides_equal_the_plans(spark, name):
    layers = Layers(spark, SF_DIR)
    for stored, planned in [
        (layers.silver(name), layers.valid(name)),
        (layers.quarantine(name), layers.quarantined(name)),
    ]:
        assert stored.columns == planned.columns
        assert sorted(map(str, stored.collect())) == sorted(map(str, planned.collect()))
