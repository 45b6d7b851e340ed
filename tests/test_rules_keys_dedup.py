import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeward.operators import dedup, keys, rollup, rules
from lakeward.operators.rules import Rule

RULES = [
    Rule("id", rules.not_null("id"), "no id"),
    Rule("amount", "amount >= 0", "negative"),
    Rule("kind", rules.in_domain("kind", ["a", "it's"]), "bad kind", on_null="fail"),
    Rule("note", rules.matches("kind", "^a"), "starts oddly", action="warn"),
]


def frame(spark):
    rows = [
        (1, 5.0, "a"),
        (None, -1.0, "a"),
        (2, None, "it's"),
        (3, 1.0, None),
        (4, -2.0, "z"),
    ]
    return spark.createDataFrame(rows, "id int, amount double, kind string")


def test_keep_and_divert_partition_the_input(spark):
    df = frame(spark)
    kept, diverted = rules.keep(df, RULES), rules.divert(df, RULES)
    assert sorted(r["id"] for r in kept.collect()) == [1, 2]
    assert kept.count() + diverted.count() == df.count()
    assert kept.intersect(diverted.select(df.columns)).count() == 0


def test_first_reason_wins_and_all_are_listed(spark):
    rows = {r["id"]: r for r in rules.divert(frame(spark), RULES).collect()}
    assert rows[None]["error_reason"] == "no id"
    assert rows[None]["error_reasons"] == ["no id", "negative"]
    assert rows[3]["error_reason"] == "bad kind"
    assert rows[4]["error_reasons"] == ["negative", "bad kind"]


def test_route_equals_keep_and_divert(spark):
    routed = rules.route(frame(spark), RULES)
    valid = routed.where(F.col("_route") == rules.VALID).select("id", "amount", "kind")
    assert valid.exceptAll(rules.keep(frame(spark), RULES)).count() == 0
    assert routed.where(F.col("_route") == rules.QUARANTINE).count() == 3


def test_warn_rules_keep_every_row(spark):
    warned = rules.warnings(frame(spark), RULES)
    assert warned.count() == 5
    assert {r["id"] for r in warned.collect() if r["_warnings"]} == {2, 4}


def test_fail_rules_stop_the_job(spark):
    strict = [Rule("amount", "amount >= 0", "negative", action="fail")]
    with pytest.raises(Exception, match="rule failed: negative"):
        rules.keep(frame(spark), strict).collect()


def test_counts_and_observation_agree(spark):
    counted = {r[0]: (r[1], r[2]) for r in rules.rule_counts(frame(spark), RULES).collect()}
    assert counted == {"id": (4, 1), "amount": (3, 2), "kind": (3, 2), "note": (3, 2)}
    from pyspark.sql import Observation

    seen = Observation("seen")
    rules.observed(frame(spark), RULES, seen).collect()
    assert seen.get["amount__failed"] == 2


@pytest.mark.parametrize(
    ("raw", "optional", "ok"),
    [("x", False, False), (None, False, False), (None, True, True), (" ", True, True), ("x", True, False)],
)
def test_parse_rule(spark, raw, optional, ok):
    df = spark.createDataFrame([(raw, None)], "raw string, parsed timestamp")
    rule = Rule("p", rules.parses("raw", "parsed", optional), "bad", on_null="fail")
    assert (rules.keep(df, [rule]).count() == 1) is ok


def hot_frame(spark):
    """A key with a third of the rows, null keys, and small keys."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(
        F.col("id") % 17 == 1, F.lit(None).cast("string")
    ).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    claim = F.when(F.col("id") % 5 != 0, F.col("id").cast("string"))
    return spark.range(3000).select("id", key.alias("key"), claim.alias("claim"))


@pytest.mark.parametrize("hot_rows", [10, 500, 1_000_000])
def test_group_count_equals_window_count(spark, hot_rows):
    df = hot_frame(spark)
    ours = keys.attach_group_count(df, "key", "claim", "n", hot_rows=hot_rows)
    window = df.withColumn("n", F.count("claim").over(Window.partitionBy("key")))
    assert ours.columns == window.columns
    assert ours.exceptAll(window).count() == 0 and ours.count() == 3000


@pytest.mark.parametrize("hot_rows", [10, 500, 1_000_000])
def test_lookup_join_equals_plain_left_join(spark, hot_rows):
    df = hot_frame(spark)
    lookup = spark.createDataFrame(
        [("hot", 1, "x"), ("k1", 2, None), ("unused", 3, "y")], "k string, a int, b string"
    )
    ours = keys.lookup_join(df, lookup, "key", "k", ["a", "b"], hot_rows=hot_rows)
    plain = df.join(lookup, F.col("key") == F.col("k"), "left").drop("k")
    assert ours.exceptAll(plain).count() == 0 and ours.count() == plain.count()


def test_hot_rows_meet_the_lookup_in_many_partitions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lookup = spark.createDataFrame([("hot", 1)], "k string, a int")
        joined = keys.lookup_join(hot_frame(spark), lookup, "key", "k", ["a"], hot_rows=500)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "_salt" in plan.split("SortMergeJoin", 1)[1].split("\n", 1)[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reference_checks(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    ref = spark.createDataFrame([("a",), ("a",), (None,)], "r string")
    assert [r[0] for r in keys.require_fk(df, ref, "k", "r").collect()] == ["a"]
    assert {r[0] for r in keys.orphans(df, ref, "k", "r").collect()} == {"b", None}
    flagged = keys.flag_orphans(df, ref, "k", "has", "r")
    assert {r["k"]: r["has"] for r in flagged.collect()} == {"a": True, "b": False, None: False}


def test_enrich_keeps_the_grain(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "a"), (3, "z")], "id int, k string")
    lookup = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new")], "k string, v int, name string")
    for split in (True, False):
        rows = keys.enrich(fact, lookup, "k", ["name"], order_by=[F.desc("v")], split_hot=split)
        assert sorted(tuple(r) for r in rows.collect()) == sorted(
            [(1, "a", "new"), (2, "a", "new"), (3, "z", None)]
        )


def test_dedup_is_deterministic_null_safe_and_idempotent(spark):
    rows = [("b", 1, None), ("a", 1, None), ("c", 2, "x")]
    df = spark.createDataFrame(rows, "id string, v int, w string")
    once = dedup.dedup_within(df, ["v", "w"], "id")
    assert sorted(r["id"] for r in once.collect()) == ["a", "c"]
    assert dedup.dedup_within(once, ["v", "w"], "id").count() == 2
    assert dedup.dedup_against(df, once, ["id", "v", "w"]).collect()[0]["id"] == "b"


def test_group_of_copies_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select("id", (F.col("id") % 2).alias("v"))
    plan = dedup.dedup_within(df, ["v"], "id")._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange hashpartitioning", 1)[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_first_version_and_upsert(spark):
    old = spark.createDataFrame([("p1", 1)], "k string, v int")
    new = spark.createDataFrame([("p1", 2), ("p2", 1), (None, 9)], "k string, v int")
    assert {r["k"] for r in dedup.first_version_wins(new, old, "k").collect()} == {"p2", None}
    merged = dedup.upsert(old, new, "k", [F.desc("v")])
    assert sorted(tuple(r) for r in merged.collect()) == [("p1", 2), ("p2", 1)]


def test_severity_bands(spark):
    frames = {
        str(n): spark.range(n).select(F.lit("r").alias("error_reason")) for n in (10, 11, 100, 101)
    }
    rows = {r["table_name"]: r for r in rollup.dq_rollup(frames).collect()}
    assert {k: r["severity"] for k, r in rows.items()} == {
        "10": "LOW",
        "11": "MEDIUM",
        "100": "MEDIUM",
        "101": "HIGH",
    }
    assert rows["101"]["affected_records"] == 101 and rows["101"]["rule_name"] == "r"
