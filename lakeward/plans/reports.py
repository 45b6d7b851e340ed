"""Prompts from reports, and the reports once a generator has answered them.

Templates are arguments: a prompt says what its caller wants to know.  Each ``*_prompts`` function
builds its prompts from columns; the function after it sends them to a generator, in tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.functions import fill_template
from lakeward.operators.anomaly import REPORT_COLUMNS, flagged
from lakeward.operators.generate import with_generated
from lakeward.operators.retrieval import TOP_K, retrieval_context, top_k

Generator = Callable[[str], str]


def _prompt(template: str, names: list[str], **shown: Column) -> Column:
    return fill_template(template, {**{n: F.col(n) for n in names}, **shown}).alias("prompt")


def claim_prompts(scored: DataFrame, template: str) -> DataFrame:
    """Flagged claims with a prompt each; the amount has two digits."""
    names = ["claim_id", "incident_severity", "incident_type", "report_delay_days", "triggered_rules"]
    amount = F.format_string("%.2f", "property")
    return flagged(scored).select(*REPORT_COLUMNS, _prompt(template, names, property=amount))


def claim_briefs(
    scored: DataFrame,
    template: str,
    generator: Generator,
    with_prompt: bool = False,
    **options,
) -> DataFrame:
    """Flagged claims with an investigation brief."""
    prompts = claim_prompts(scored, template)
    written = with_generated(prompts, "prompt", "investigation_brief", generator, **options)
    return written.select(*REPORT_COLUMNS, "investigation_brief", *["prompt"] * with_prompt)


def issue_prompts(issues: DataFrame, template: str) -> DataFrame:
    """One prompt per quality issue, under a stable id.

    The window numbers all issues in one task; issues are one row per table and rule, bounded
    by the number of rules, not by the data.
    """
    order = Window.orderBy("table_name", "rule_name")
    names = ["table_name", "rule_name", "severity", "affected_records"]
    number = F.row_number().over(order).cast("string").alias("issue_id")
    return issues.select(number, *names, _prompt(template, names))


def issue_explanations(
    issues: DataFrame,
    template: str,
    model_name: str,
    run_ts: Column,
    generator: Generator,
    with_prompt: bool = False,
    **options,
) -> DataFrame:
    """One explanation per quality issue, with the state of the call."""
    options.setdefault("failed_text", None)
    prompts = issue_prompts(issues, template)
    explained = with_generated(prompts, "prompt", "ai_explanation", generator, **options)
    return explained.select(
        *prompts.columns[:-1],
        "ai_explanation",
        F.lit(model_name).alias("model_name"),
        "generation_status",
        run_ts.alias("generated_timestamp"),
        *["prompt"] * with_prompt,
    )


def kpi_rows(kpis: dict[str, DataFrame]) -> DataFrame:
    """(domain, kpi_json): one row per domain, figures as JSON."""
    rows = [
        df.select(F.lit(domain).alias("domain"), F.to_json(F.struct("*")).alias("kpi_json"))
        for domain, df in kpis.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def summary_prompts(kpis: dict[str, DataFrame], template: str) -> DataFrame:
    """(domain, kpi_json, prompt): one row per domain."""
    return kpi_rows(kpis).select(
        "domain", "kpi_json", _prompt(template, ["domain", "kpi_json"])
    )


def domain_summaries(
    kpis: dict[str, DataFrame],
    template: str,
    model_name: str,
    run_ts: Column,
    generator: Generator,
    with_prompt: bool = False,
    **options,
) -> DataFrame:
    """Executive summary per domain; the status is that of the call, failures included."""
    prompts = summary_prompts(kpis, template)
    written = with_generated(prompts, "prompt", "executive_summary", generator, **options)
    return written.select(
        "domain",
        "executive_summary",
        "kpi_json",
        run_ts.alias("created_at"),
        F.lit(model_name).alias("model_name"),
        F.col("generation_status").alias("status"),
        *["prompt"] * with_prompt,
    )


def question_prompts(
    questions: DataFrame, chunks: DataFrame, owner: str, template: str, k: int = TOP_K
) -> DataFrame:
    """(question_id, question, prompt, confidence_score, source_policies) per question.

    ``questions``: question_id, question, embedding; ``chunks``: chunk_id, owner, text,
    embedding.  Source policies stay an array.
    """
    context = retrieval_context(top_k(questions, chunks, k, carry=[owner, "text"]), owner)
    asked = questions.select("question_id", "question").join(context, "question_id")
    return asked.select(
        "question_id",
        "question",
        _prompt(template, ["context", "question"]),
        "confidence_score",
        "source_policies",
    )


def answer_questions(
    questions: DataFrame,
    chunks: DataFrame,
    owner: str,
    template: str,
    run_ts: Column,
    generator: Generator,
    k: int = TOP_K,
    **options,
) -> DataFrame:
    """A table of questions to rows of the query history, as one batch."""
    prompts = question_prompts(questions, chunks, owner, template, k)
    answered = with_generated(prompts, "prompt", "answer", generator, **options)
    return answered.select(
        "question", "answer", "confidence_score", "source_policies", run_ts.alias("timestamp")
    )
