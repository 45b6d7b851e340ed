"""Rule-based anomaly scoring of claims."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.functions import days_between
from lakeward.operators.keys import attach_group_count

# Rule weights, limits, tiers and defaults.
WEIGHTS = {
    "r1_high_claim_amount": 0.25,
    "r2_severity_mismatch": 0.25,
    "r3_repeat_claimant": 0.20,
    "r4_reporting_delay": 0.15,
    "r5_missing_docs": 0.15,
}
RULE_LABELS = {
    "r1_high_claim_amount": "R1",
    "r2_severity_mismatch": "R2",
    "r3_repeat_claimant": "R3",
    "r4_reporting_delay": "R4",
    "r5_missing_docs": "R5",
}
TIERS = [(70, "HIGH"), (45, "MEDIUM"), (40, "LOW")]
NORMAL = "NORMAL"
MILD_SEVERITY = "Trivial Damage"
MILD_LIMIT = 5000
REPEAT_ABOVE = 2
DELAY_ABOVE = 3
NO_REPORT = "NO"
DEFAULTS = {
    "incident_type": "UNKNOWN",
    "incident_severity": "UNKNOWN",
    "police_report_available": "NO",
    "witnesses": 0,
}
REPORT_COLUMNS = [
    "claim_id",
    "property",
    "incident_severity",
    "incident_type",
    "anomaly_score",
    "priority_tier",
    "triggered_rules",
]


def prepare(claims: DataFrame) -> DataFrame:
    """Add the reporting delay and replace missing values by their defaults."""
    delay = days_between(F.col("claim_logged_on"), F.col("incident_date"))
    return claims.withColumn("report_delay_days", delay).fillna(DEFAULTS)


def moments(df: DataFrame, column: str) -> DataFrame:
    """One row: struct of mean and sample standard deviation."""
    return df.agg(
        F.struct(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std")).alias("moments")
    )


def zscore(
    df: DataFrame,
    column: str,
    out: str = "r1_high_claim_amount",
    z_cap: float | None = None,
    null_as_mean: bool = False,
) -> DataFrame:
    """Distance from the mean in standard deviations, as an absolute value.

    The moments stay in the plan as a scalar subquery.  A null amount gives a null
    score and equal amounts give null, unless ``null_as_mean`` asks for 0; the value
    is unbounded unless ``z_cap`` is set.
    """
    stats = df.withColumn("_moments", moments(df, column).scalar())
    distance = F.col(column) - F.col("_moments.mean")
    score = F.abs(F.try_divide(distance, F.col("_moments.std")))
    if z_cap is not None:
        score = F.when(score > z_cap, F.lit(float(z_cap))).otherwise(score)
    if null_as_mean:
        score = F.coalesce(score, F.lit(0.0))
    return stats.withColumn(out, score).drop("_moments")


def _flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def severity_mismatch(limit: float = MILD_LIMIT) -> Column:
    return _flag((F.col("incident_severity") == MILD_SEVERITY) & (F.col("property") > limit))


def repeat_claimant(more_than: int = REPEAT_ABOVE) -> Column:
    return _flag(F.col("policy_count") > more_than)


def reporting_delay(days: int = DELAY_ABOVE) -> Column:
    return _flag(F.col("report_delay_days") > days)


def missing_evidence() -> Column:
    return _flag((F.col("police_report_available") == NO_REPORT) & (F.col("witnesses") == 0))


def weighted_score(weights: dict[str, float] = WEIGHTS) -> Column:
    """Sum of rule values times weights, in percent."""
    return reduce(add, [F.col(name) * F.lit(w) for name, w in weights.items()]) * 100


def tier(score: Column, cuts: list[tuple[float, str]] = TIERS) -> Column:
    level = F.lit(NORMAL)
    for bound, name in sorted(cuts):
        level = F.when(score >= bound, F.lit(name)).otherwise(level)
    return level


def triggered(labels: dict[str, str] = RULE_LABELS) -> Column:
    """Comma list of the rules with a positive value."""
    return F.concat_ws(",", *[F.when(F.col(n) > 0, F.lit(tag)) for n, tag in labels.items()])


def score_claims(claims: DataFrame, z_cap: float | None = None) -> DataFrame:
    """Claims with the five rule columns, score, tier and the rules that fired."""
    ready = prepare(claims)
    counted = attach_group_count(ready, "policy_id", "claim_id", "policy_count")
    rules = zscore(counted, "property", z_cap=z_cap).withColumns(
        {
            "r2_severity_mismatch": severity_mismatch(),
            "r3_repeat_claimant": repeat_claimant(),
            "r4_reporting_delay": reporting_delay(),
            "r5_missing_docs": missing_evidence(),
        }
    )
    return rules.withColumn("anomaly_score", weighted_score()).withColumns(
        {"priority_tier": tier(F.col("anomaly_score")), "triggered_rules": triggered()}
    )


def flagged(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("priority_tier") != NORMAL)


def anomaly_report(scored: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Flagged claims in the report's column order."""
    return flagged(scored).select(*REPORT_COLUMNS, *(extra or []))


def by_score(report: DataFrame, tier_name: str) -> DataFrame:
    return report.where(F.col("priority_tier") == tier_name).orderBy(F.desc("anomaly_score"))
