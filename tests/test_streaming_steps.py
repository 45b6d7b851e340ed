"""Order of steps, watermarks that move, logs that grow, hot keys inside a stream."""

import json
import time

import pytest
from pyspark.sql import functions as F

from lakeward.operators import keys
from lakeward.plans import entities as ent
from lakeward.sources.tables import optional_path
from lakeward.streaming import steps


def step(name, *inputs):
    return steps.Step(name, lambda s: None, name, inputs=list(inputs))


def names(found):
    return [s.name for s in found]


def test_steps_follow_their_inputs():
    assert names(steps.ordered([step("c", "b"), step("d"), step("b", "a"), step("a")])) == ["d", "a", "b", "c"]
    assert steps.ordered([]) == []


@pytest.mark.parametrize(
    ("plan", "says"),
    [
        ([step("a", "b"), step("b", "c"), step("c", "a"), step("d")], "wait for each other: .'a', 'b', 'c'"),
        ([step("a", "a")], "wait for each other"),
        ([step("a", "x")], "no step"),
        ([step("a"), step("a")], "one name"),
    ],
)
def test_steps_without_an_order_are_refused(plan, says):
    with pytest.raises(ValueError, match=says):
        steps.ordered(plan)


def rows_step(landing, out, delay="1 day"):
    def build(s):
        rows = s.readStream.schema("id string, t timestamp").option("maxFilesPerTrigger", 1).json(landing)
        return steps.dedup_stream(rows, "t", delay, ["id", "t"])

    return steps.Step("dedup", build, out)


def test_batches_of_one_run_move_the_watermark_and_evict_state(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    batches = [
        ["2024-01-01", "2024-01-01", "2024-01-02"],
        ["2024-01-10", "2024-01-11", "2024-01-11"],
        ["2024-01-01", "2024-01-11", "2024-01-12"],
    ]
    for n, days in enumerate(batches):
        lines = [json.dumps({"id": "x", "t": f"{d}T00:00:00"}) for d in days]
        (landing / f"{n}.json").write_text("\n".join(lines))
        time.sleep(0.02)
    out = str(tmp_path / "out")
    progress = steps.run_step(spark, rows_step(str(landing), out), str(tmp_path / "ck"))
    found = sorted(str(r["t"])[:10] for r in spark.read.parquet(out).collect())
    assert found == ["2024-01-01", "2024-01-02", "2024-01-10", "2024-01-11", "2024-01-12"]
    state = [p["stateOperators"][0] for p in progress]
    assert sum(s["numRowsDroppedByWatermark"] for s in state) == 1
    # Days before the last one are out of state at the end.
    assert max(s["numRowsTotal"] for s in state) >= 3 and state[-1]["numRowsTotal"] <= 2


def test_the_log_grows_while_a_step_runs(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    for n in range(4):
        (landing / f"{n}.txt").write_text(f"{n}\n")
        time.sleep(0.02)

    def build(s):
        lines = s.readStream.option("maxFilesPerTrigger", 1).text(str(landing))
        return lines.where(F.length(F.repeat("value", 10)) > 0)

    found = list(steps.finished_batches(spark, steps.Step("slow", build, out), str(tmp_path / "ck"), 0.05))
    batches = [p["batchId"] for some in found for p in some if p["numInputRows"]]
    assert batches == [0, 1, 2, 3] and len(found) > 1


def test_hot_and_null_keys_are_split_inside_a_stream(spark, tmp_path, monkeypatch):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [("hot", i) for i in range(300)] + [(None, i) for i in range(50)] + [(f"k{i}", i) for i in range(60)]
    schema = "policy string, n long"
    spark.createDataFrame(rows, schema).write.parquet(landing)
    lookup = spark.createDataFrame([("hot", "H"), *[(f"k{i}", str(i)) for i in range(30)]], "key string, owner string")
    monkeypatch.setattr(keys, "fits_broadcast", lambda df: False)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        for number, counted in enumerate([True, False]):

            def build(s, counted=counted):
                stored = steps.unread(s, landing, out + "none") if counted else None
                return keys.lookup_join(
                    steps.stream_table(s, landing), lookup, "policy", "key", ["owner"], ["n"],
                    hot_rows=100, counted=stored,
                ).withColumn("task", F.spark_partition_id())

            here = steps.Step(f"join{number}", build, f"{out}{number}")
            steps.run_step(spark, here, str(tmp_path / "ck"))
            found = spark.read.parquet(here.path)
            known = {None: None, "hot": "H", **{f"k{i}": str(i) if i < 30 else None for i in range(60)}}
            assert found.count() == 410
            assert all(r["owner"] == known[r["policy"]] for r in found.collect())
            tasks = dict(found.groupBy("policy").agg(F.countDistinct("task")).collect())
            assert tasks[None] > 1 and (tasks["hot"] > 1) == counted
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_references_are_read_anew_for_every_run(spark, tmp_path):
    root = str(tmp_path)
    columns = ["ClaimID", "PolicyID", "incident_date", "incident_state", "incident_city",
               "incident_location", "incident_type", "incident_severity", "injury", "property",
               "vehicle", "authorities_contacted", "number_of_vehicles_involved", "property_damage",
               "collision_type", "bodily_injuries", "witnesses", "police_report_available",
               "Claim_Rejected", "Claim_Logged_On", "Claim_Processed_On"]
    schema = ", ".join(f"{c} string" for c in columns)

    def build(s):
        refs = {"policy": s.read.parquet(f"{root}/policy")}
        coming = steps.unread(s, f"{root}/in", f"{root}/out")
        return steps.split_stream(ent.CLAIMS, steps.stream_table(s, f"{root}/in"), refs, coming)

    here = steps.Step("claims", build, f"{root}/out", ["_route"])
    for number, policy in enumerate(["P1", "P2"]):
        claims = [{"ClaimID": f"C{number}{p}", "PolicyID": p, "Claim_Rejected": "Y"} for p in ("P1", "P2")]
        spark.createDataFrame(claims, schema).write.mode("append").parquet(f"{root}/in")
        spark.createDataFrame([(policy,)], "policy_number string").write.mode("append").parquet(f"{root}/policy")
        steps.run_step(spark, here, f"{root}/ck")
    routes = {r["claim_id"]: r["_route"] for r in optional_path(spark, f"{root}/out").collect()}
    assert routes == {"C0P1": "valid", "C0P2": "quarantine", "C1P1": "valid", "C1P2": "valid"}
