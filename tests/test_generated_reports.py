"""The queries of generated text give the whole reports, not only what a model would be asked."""

import json
from pathlib import Path

import pytest

from lakeward.plans.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not mounted")


def test_every_flagged_claim_has_a_brief(spark):
    briefs = QUERIES["generated_briefs"](spark, SF_DIR)
    assert {"investigation_brief", "prompt"} < set(briefs.columns)
    rows = briefs.select("triggered_rules", "investigation_brief").distinct().collect()
    assert rows and all(r["investigation_brief"].startswith("To do: ") for r in rows)
    for rule, check in (("R2", "damage inspected"), ("R5", "police report")):
        assert all((rule in r[0]) == (check in r[1]) for r in rows)


def test_every_issue_has_an_explanation_and_a_state(spark):
    issues = QUERIES["dq_explanations"](spark, SF_DIR)
    assert {"issue_id", "model_name", "generated_timestamp", "prompt"} < set(issues.columns)
    rows = issues.select("rule_name", "ai_explanation", "generation_status").collect()
    assert rows and {r["generation_status"] for r in rows} == {"SUCCESS"}
    told = {r["rule_name"]: r["ai_explanation"] for r in rows}
    assert told["negative balance"] == "Likely cause: a sign is wrong."


def test_every_domain_has_a_summary_and_a_state(spark):
    domains = QUERIES["domain_summaries"](spark, SF_DIR)
    assert {"kpi_json", "created_at", "model_name", "prompt"} < set(domains.columns)
    rows = domains.select("domain", "executive_summary", "status", "kpi_json").collect()
    assert len(rows) == 3 and {r["status"] for r in rows} == {"SUCCESS"}
    for row in rows:
        for name, value in json.loads(row["kpi_json"], parse_int=str, parse_float=str).items():
            assert f"{name.replace('_', ' ')} {value}" in row["executive_summary"]
