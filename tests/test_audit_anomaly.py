import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lakeward.operators import anomaly, audit

LOG = (
    "origin struct<pipeline_id: string, pipeline_name: string, update_id: string, "
    "flow_name: string>, event_type string, timestamp timestamp, details string"
)


def event(minute, status, flow="cars", kind="flow_progress", **details):
    body = {"flow_progress": {"status": status, **details}}
    return (("p", "name", "u", flow), kind, dt.datetime(2024, 1, 1, 0, minute), json.dumps(body))


def audited(spark, *events):
    log = spark.createDataFrame(list(events), LOG)
    return audit.audit_metrics(log, F.lit("2024-01-02").cast("timestamp"))


def expectation(passed):
    return {"name": "valid_id", "dataset": "cars", "passed_records": passed, "failed_records": 1}


def test_audit_of_one_run(spark):
    rows = audited(
        spark,
        event(0, "STARTING"),
        event(1, "RUNNING", metrics={"num_output_rows": 5, "num_upserted_rows": 1},
              data_quality={"dropped_records": 2, "expectations": [expectation(9)]}),
        event(2, "RUNNING", metrics={"num_output_rows": 7},
              data_quality={"dropped_records": 1, "expectations": [expectation(3)]}),
        event(3, "FAILED"),
        event(4, None),
        event(9, "RUNNING", flow="pipelines.flowTimeMetrics.missingFlowName"),
        event(9, "RUNNING", flow=None),
        event(9, "RUNNING", kind="user_action"),
    ).collect()
    assert len(rows) == 1 and len(rows[0]) == 14
    run = rows[0]
    assert run["final_status"] == "FAILED" and run["duration_seconds"] == 180.0
    assert (run["total_output_rows"], run["total_upserted_rows"], run["total_deleted_rows"]) == (12, 1, 0)
    assert run["total_dropped_rows"] == 2
    assert run["expectations"][0]["passed_records"] == 3  # the latest, not the largest


def test_expectation_summary_skips_missing(spark):
    run = audited(
        spark,
        event(0, "RUNNING", data_quality={"expectations": [expectation(4), None]}),
        event(1, "RUNNING", flow="sales", data_quality={"expectations": []}),
        event(1, "RUNNING", flow="policy"),
    )
    rows = audit.expectation_summary(run).collect()
    assert [(r["dataset_name"], r["passed_records"], r["failed_records"]) for r in rows] == [("cars", 4, 1)]
    assert len(rows[0]) == 10


def test_run_without_timed_status(spark):
    run = audited(spark, event(0, None)).first()
    assert run["start_time"] is None and run["duration_seconds"] is None and run["final_status"] is None


SCHEMA = (
    "claim_id string, policy_id string, incident_date timestamp, claim_logged_on timestamp, "
    "property double, incident_severity string, incident_type string, "
    "police_report_available string, witnesses int"
)


def claim(cid, policy="P", amount=100.0, delay=0, severity="Major Damage", report="YES", witnesses=1):
    start = dt.datetime(2024, 1, 1)
    return (cid, policy, start, start + dt.timedelta(days=delay), amount, severity, None, report, witnesses)


def scored(spark, *rows, **options):
    df = spark.createDataFrame(list(rows), SCHEMA)
    return {r["claim_id"]: r for r in anomaly.score_claims(df, **options).collect()}


def test_rule_thresholds(spark):
    rows = scored(
        spark,
        claim("a", "P2", 5000.0, 3, "Trivial Damage", "NO", 0),
        claim("b", "P2", 5000.01, 4, "Trivial Damage", None, None),
        claim("c", "P3", 1.0, 0, report="UNKNOWN", witnesses=0),
        claim("d", "P3", 1.0),
        claim("e", "P3", None),
    )
    assert [rows[c]["r2_severity_mismatch"] for c in "abc"] == [0, 1, 0]
    assert [rows[c]["policy_count"] for c in "abcde"] == [2, 2, 3, 3, 3]
    assert [rows[c]["r3_repeat_claimant"] for c in "abcde"] == [0, 0, 1, 1, 1]
    assert [rows[c]["r4_reporting_delay"] for c in "ab"] == [0, 1]
    assert [rows[c]["r5_missing_docs"] for c in "abc"] == [1, 1, 0]
    assert rows["e"]["anomaly_score"] is None and rows["e"]["priority_tier"] == "NORMAL"
    assert rows["b"]["incident_type"] == "UNKNOWN" and "R2,R4,R5" in rows["b"]["triggered_rules"]


def test_equal_amounts_have_no_zscore(spark):
    rows = scored(spark, claim("a"), claim("b", "Q"))
    assert rows["a"]["r1_high_claim_amount"] is None
    df = spark.createDataFrame([claim("a"), claim("b", amount=None)], SCHEMA)
    assert [r["z"] for r in anomaly.zscore(df, "property", "z", null_as_mean=True).collect()] == [0.0, 0.0]


def test_z_cap(spark):
    many = [claim(str(i), str(i), 1.0) for i in range(50)] + [claim("x", "x", 1e6)]
    df = spark.createDataFrame(many, SCHEMA)
    assert max(r["z"] for r in anomaly.zscore(df, "property", "z", z_cap=1.0).collect()) == 1.0


@pytest.mark.parametrize(
    ("score", "name"),
    [(39.99, "NORMAL"), (40.0, "LOW"), (44.99, "LOW"), (45.0, "MEDIUM"), (69.99, "MEDIUM"),
     (70.0, "HIGH"), (None, "NORMAL")],
)
def test_tiers(spark, score, name):
    df = spark.createDataFrame([(score,)], "s double")
    assert df.select(anomaly.tier(F.col("s"))).first()[0] == name


def test_report_and_order(spark):
    df = spark.createDataFrame(
        [claim(str(i), str(i % 5), float(i * 100), i % 7, "Trivial Damage", "NO", 0) for i in range(99)], SCHEMA
    )
    report = anomaly.anomaly_report(anomaly.score_claims(df))
    assert report.columns == anomaly.REPORT_COLUMNS
    scores = [r["anomaly_score"] for r in anomaly.by_score(report, "HIGH").collect()]
    assert scores and scores == sorted(scores, reverse=True) and min(scores) >= 70
