"""Named queries: every operator over the whole test tables.

``QUERIES[name](spark, sf_dir)`` returns a frame; ``oracles.ORACLES[name]`` is the
same result in SQL.  Dates and times leave as text and lists as joined text, so that
results compare across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions import (
    blank_to_null,
    days_between,
    expand_code,
    fill_template,
    first_number,
    first_of,
    letters_only,
    parse_date,
    parse_timestamp,
    repair_timestamp,
    swap_misfiled,
    title,
    unless_placeholder,
    yes_no,
)
from lakeward.operators import anomaly, audit, generate, retrieval, rules
from lakeward.operators.dedup import (
    dedup_within,
    first_version_wins,
    upsert,
)
from lakeward.operators.keys import flag_orphans, orphans, require_fk
from lakeward.plans import entities as ent
from lakeward.plans import answers, kpi, reports
from lakeward.plans.exercises import (
    csv_drift_table,
    incremental_table,
    json_table,
    stream_dedup_table,
    stream_facts,
    stream_references,
    stream_run_log,
    stream_split_table,
)
from lakeward.plans.layers import AS_OF, RUN_TS, Layers
from lakeward.sources import ledger
from lakeward.sources.files import LOADED, RESCUED, SOURCE, rescued
from lakeward.sources.tables import append_batch, shared_folder

BRIEF_TEMPLATE = (
    "Claim {claim_id}: {incident_type}, {incident_severity}, amount {property}, reported after "
    "{report_delay_days} days, rules {triggered_rules}. What should be looked into?"
)
ISSUE_TEMPLATE = (
    "{affected_records} rows of {table_name} are in quarantine for '{rule_name}' ({severity}). "
    "What may have caused this?"
)
SUMMARY_TEMPLATE = "{domain}, in figures: {kpi_json} Which of them stand out?"
ANSWER_TEMPLATE = "{context}\nAnswer from these passages alone: {question}"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates, times and lists of text as plain text."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "; ")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(name: str) -> Callable[[Callable[[Layers], DataFrame]], Query]:
    """Register a query under ``name``."""

    def register(build: Callable[[Layers], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(Layers(spark, sf_dir)))

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        return run

    return register


# --- ingest -------------------------------------------------------------------------------


@query("ingest_csv_header_drift")
def _(layers: Layers) -> DataFrame:
    """Customers written under three header variants, in files that URLs escape, read by name."""
    bronze = csv_drift_table(layers.spark, layers.raw("customers"))
    folder = F.regexp_extract(SOURCE, "customers[^/]*", 0)
    return ent.clean_customers(bronze).select(
        *ent.CUSTOMERS.columns, folder.alias("source_folder"), F.col(LOADED).alias("load_ts")
    )


@query("ingest_json_multiline")
def _(layers: Layers) -> DataFrame:
    """Claims in two loads of JSON arrays: a declared and an undeclared key change their types."""
    bronze = json_table(layers.spark, layers.raw("claims"))
    place = F.try_variant_get(F.try_parse_json("incident_location"), "$.place", "string")
    claims = bronze.withColumn("incident_location", F.coalesce(place, "incident_location"))
    return ent.clean_claims(claims).select(
        *ent.CLAIMS.columns,
        RESCUED,
        rescued("Notes").alias("notes"),
        rescued("Notes", "int").alias("notes_length"),
        rescued("adjuster").alias("adjuster"),
    )


@query("ingest_incremental_replay")
def _(layers: Layers) -> DataFrame:
    """Cars arriving in three drops, loaded after each and once more: every row once."""
    return ent.clean_cars(incremental_table(layers.spark, layers.raw("cars"))).select(
        *ent.CARS.columns
    )


# --- column functions ---------------------------------------------------------------------


@query("clean_text_columns")
def _(layers: Layers) -> DataFrame:
    return layers.table("documents").select(
        "doc_id",
        F.md5(F.trim("text").cast("binary")).alias("trimmed_md5"),
        F.length(F.trim("text")).alias("trimmed_length"),
        F.upper(F.trim("lang")).alias("lang_upper"),
        F.lower(F.concat(F.lit(" "), F.upper("source"))).alias("source_lower"),
        title(F.concat_ws(" ", F.lit(" "), "source", F.lit("OF"), "lang")).alias("source_title"),
        letters_only(F.concat(F.col("source"), F.lit("-#"), F.col("lang"))).alias("source_letters"),
        blank_to_null(F.regexp_replace("lang", "en", "  ")).alias("lang_or_null"),
    )


@query("extract_number_from_text")
def _(layers: Layers) -> DataFrame:
    return layers.table("part").select(
        "p_partkey",
        first_number(F.col("p_brand"), "int").alias("brand_number"),
        first_number(F.concat(F.lit("about "), F.col("p_retailprice").cast("string"), F.lit(" USD"))).alias(
            "price"
        ),
        first_number(F.col("p_type")).alias("no_number"),
    )


@query("code_expansion")
def _(layers: Layers) -> DataFrame:
    raw = layers.raw("customers").withColumn("code", F.coalesce("Region", "Reg"))
    return raw.groupBy("code", expand_code(F.col("code")).alias("region")).agg(
        F.count(F.lit(1)).alias("customers")
    )


@query("first_of_aliases")
def _(layers: Layers) -> DataFrame:
    raw = layers.raw("customers")
    return raw.select(
        F.trim(first_of(raw, "CustomerID", "Customer_ID", "cust_id")).alias("customer_id"),
        first_of(raw, "Region", "Reg").alias("region"),
        first_of(raw, "City", "City_in_state").alias("city"),
        first_of(raw, "no_such_column").alias("absent"),
    )


@query("null_if_placeholder")
def _(layers: Layers) -> DataFrame:
    return layers.raw("policy").select(
        F.trim("policy_number").alias("policy_number"),
        unless_placeholder(F.col("policy_state"), F.upper(F.trim("policy_state"))).alias("state"),
        unless_placeholder(F.col("policy_csl"), F.trim("policy_csl")).alias("csl"),
        blank_to_null(F.col("car_id")).alias("car_id"),
    )


@query("flag_normalisation")
def _(layers: Layers) -> DataFrame:
    raw = layers.raw("claims")
    return raw.groupBy(
        yes_no(F.col("Claim_Rejected")).alias("rejected"),
        yes_no(F.col("police_report_available")).alias("report"),
    ).agg(F.count(F.lit(1)).alias("claims"))


@query("swap_misfiled_fields")
def _(layers: Layers) -> DataFrame:
    raw = layers.raw("customers")
    named = raw.select(
        blank_to_null(first_of(raw, "CustomerID", "Customer_ID", "cust_id")).alias("CustomerID"),
        title(first_of(raw, "Marital_status", "Marital")).alias("Marital"),
        title(first_of(raw, "Education", "Edu")).alias("Education"),
    )
    return swap_misfiled(
        named, "Marital", "Education", ent.MARITAL_VALUES, ent.EDUCATION_VALUES
    )


@query("repair_timestamp")
def _(layers: Layers) -> DataFrame:
    return layers.raw("claims").select(
        F.trim("ClaimID").alias("claim_id"),
        repair_timestamp(F.col("incident_date")).alias("incident_date"),
        repair_timestamp(F.col("Claim_Processed_On")).alias("processed_on"),
    )


@query("parse_date_formats")
def _(layers: Layers) -> DataFrame:
    return layers.raw("sales").select(
        F.trim("sales_id").alias("sales_id"),
        parse_timestamp(F.col("ad_placed_on")).alias("ad_placed_on"),
        parse_timestamp(F.col("sold_on")).alias("sold_on"),
        parse_date(F.col("ad_placed_on"), "yyyy/MM/dd").alias("other_format"),
    )


@query("derived_delays_and_status")
def _(layers: Layers) -> DataFrame:
    claims = layers.cleaned("claims")
    return claims.select(
        "claim_id",
        "claim_status",
        "claim_processing_days",
        days_between(F.col("claim_logged_on"), F.col("incident_date")).alias("report_delay_days"),
    )


@query("policy_age")
def _(layers: Layers) -> DataFrame:
    return layers.silver("policy").select("policy_number", "policy_bind_date", "policy_age_days")


# --- entities -----------------------------------------------------------------------------


def _register_entity(name: str) -> None:
    entity = ent.ENTITIES[name]
    query(f"{name}_cleaned")(lambda layers: layers.cleaned(name).select(*entity.columns))
    query(f"{name}_valid")(lambda layers: layers.valid(name))
    query(f"{name}_quarantine")(lambda layers: layers.quarantined(name))


for _name in ent.ENTITIES:
    _register_entity(_name)


# --- rules --------------------------------------------------------------------------------


@query("rule_counts")
def _(layers: Layers) -> DataFrame:
    """Passed and failed rows per claim rule."""
    return rules.rule_counts(layers.checked("claims"), ent.CLAIM_RULES)


@query("rule_warnings")
def _(layers: Layers) -> DataFrame:
    """Customers with the warn rules they break; no row is lost."""
    return rules.warnings(layers.cleaned("customers"), ent.CUSTOMER_RULES).select(
        "CustomerID", "State", "City", "_warnings"
    )


@query("rule_routes")
def _(layers: Layers) -> DataFrame:
    """Both sides of the sales rules from one evaluation, counted per reason."""
    routed = rules.route(layers.checked("sales"), ent.SALES_RULES)
    return routed.groupBy(F.col("_route").alias("route"), "error_reason").agg(
        F.count(F.lit(1)).alias("sales")
    )


# --- references ---------------------------------------------------------------------------


@query("fk_valid")
def _(layers: Layers) -> DataFrame:
    policy = layers.cleaned("policy").select("policy_number", "customer_id")
    return require_fk(policy, layers.silver("customers"), "customer_id", "CustomerID")


@query("fk_orphans")
def _(layers: Layers) -> DataFrame:
    policy = layers.cleaned("policy").select("policy_number", "customer_id")
    return orphans(policy, layers.silver("customers"), "customer_id", "CustomerID")


@query("fk_flagged")
def _(layers: Layers) -> DataFrame:
    policy = layers.cleaned("policy").select("policy_number", "car_id", "customer_id")
    with_car = flag_orphans(policy, layers.silver("cars"), "car_id", "has_car")
    return flag_orphans(
        with_car, layers.silver("customers"), "customer_id", "has_customer", "CustomerID"
    )


# --- duplicates ---------------------------------------------------------------------------


@query("dedup_business_cols")
def _(layers: Layers) -> DataFrame:
    cars = layers.cleaned("cars").select(*ent.CARS.columns)
    return dedup_within(cars, ent.CARS.dedup_columns, "car_id")


@query("dedup_claims")
def _(layers: Layers) -> DataFrame:
    claims = layers.cleaned("claims").select(*ent.CLAIMS.columns)
    return dedup_within(claims, ent.CLAIMS.dedup_columns, "claim_id")


@query("dedup_documents")
def _(layers: Layers) -> DataFrame:
    """Exact copies by digest: the texts themselves are not shuffled."""
    docs = layers.table("documents")
    return dedup_within(docs, [F.sha2(F.col("text").cast("binary"), 256)], "doc_id").select(
        "doc_id", "lang", "source", "n_chars"
    )


@query("dedup_against_existing_nullsafe")
def _(layers: Layers) -> DataFrame:
    """Cleaned cars that an earlier load has not stored, by the ledger of its contents."""
    cars, columns = layers.cleaned("cars").select(*ent.CARS.columns), ent.CARS.columns
    path = f"{shared_folder(layers.spark)}/contents-{uuid.uuid4().hex}"
    ledger.enter(layers.silver("cars"), path, columns, load=1)
    return ledger.unseen(layers.spark, cars, path, columns, load=2)


@query("dedup_first_version_wins")
def _(layers: Layers) -> DataFrame:
    policy = layers.cleaned("policy").select(*ent.POLICY.columns)
    return first_version_wins(policy, layers.silver("policy"), "policy_number")


# --- dimensions, facts, KPIs --------------------------------------------------------------


@query("dim_upsert_latest")
def _(layers: Layers) -> DataFrame:
    """Customer snapshot updated by every order: the latest order's amount stays."""
    old = layers.table("customer").select(
        F.col("c_custkey").alias("customer"),
        F.lit("1990-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
        F.col("c_acctbal").alias("amount"),
    )
    new = layers.table("orders").select(
        F.col("o_custkey").alias("customer"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_totalprice").alias("amount"),
    )
    return upsert(old, new, "customer", [F.desc("updated_at"), F.desc("amount")])


query("dim_customers")(lambda layers: layers.dim_customers)
query("dim_policy")(lambda layers: layers.dim_policy)
query("dim_cars")(lambda layers: layers.dim_cars)


@query("dim_cars_two_batches")
def _(layers: Layers) -> DataFrame:
    """Cars after a second load, run twice, that renames every petrol car: its rows stay."""

    def loaded(cars: DataFrame, day: str) -> DataFrame:
        return cars.withColumn("insert_timestamp", F.lit(day).cast("timestamp"))

    own = Layers(layers.spark, layers.sf_dir, fresh=True)
    first = layers.silver("cars")
    petrol = first.where(F.lower("fuel") == "petrol")
    second = petrol.withColumn("name", F.concat(F.lit("~"), "name"))
    own.load_dimension("cars", loaded(first, "2024-01-01"), 1)
    for _ in range(2):
        found = own.load_dimension("cars", loaded(second, "2024-01-02"), 2)
    return found


query("fact_claims")(lambda layers: layers.fact_claims)
query("fact_sales")(lambda layers: layers.fact_sales)


@query("claim_rejection_rate_by_region_policy")
def _(layers: Layers) -> DataFrame:
    return kpi.claim_rejection_rate(layers.fact_claims, layers.dim_policy, layers.dim_customers)


@query("avg_claim_processing_time_by_region")
def _(layers: Layers) -> DataFrame:
    return kpi.avg_processing_time(layers.fact_claims, layers.dim_customers)


@query("unsold_cars_by_model_region")
def _(layers: Layers) -> DataFrame:
    return kpi.unsold_cars(layers.fact_sales, layers.dim_cars)


def _rounded(df: DataFrame) -> DataFrame:
    """Averages to two digits, so the order of summation does not show."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({n: F.round(n, 2) for n in doubles})


query("customer_kpis")(lambda layers: _rounded(kpi.customer_kpis(layers.dim_customers)))
query("policy_kpis")(lambda layers: _rounded(kpi.policy_kpis(layers.dim_policy)))
query("claims_kpis")(lambda layers: _rounded(kpi.claims_kpis(layers.fact_claims)))


# --- quality and audit --------------------------------------------------------------------


query("dq_issues_by_rule")(lambda layers: layers.issues)


@query("audit_metrics")
def _(layers: Layers) -> DataFrame:
    return layers.audit.withColumn("expectations", F.to_json("expectations"))


query("audit_expectations")(lambda layers: audit.expectation_summary(layers.audit))


# --- anomaly ------------------------------------------------------------------------------


@query("anomaly_zscore")
def _(layers: Layers) -> DataFrame:
    scored = anomaly.zscore(layers.cleaned("claims"), "property", "z")
    return scored.select("claim_id", F.round("z", 6).alias("z"))


@query("anomaly_rules")
def _(layers: Layers) -> DataFrame:
    return layers.scored.select(
        "claim_id",
        "report_delay_days",
        "policy_count",
        "r2_severity_mismatch",
        "r3_repeat_claimant",
        "r4_reporting_delay",
        "r5_missing_docs",
    )


@query("anomaly_scored")
def _(layers: Layers) -> DataFrame:
    return layers.scored.select(
        "claim_id",
        F.round("anomaly_score", 6).alias("anomaly_score"),
        "priority_tier",
        "triggered_rules",
    )


@query("anomaly_report")
def _(layers: Layers) -> DataFrame:
    report = anomaly.anomaly_report(layers.scored)
    return report.withColumn("anomaly_score", F.round("anomaly_score", 6))


@query("anomaly_top")
def _(layers: Layers) -> DataFrame:
    """The HIGH tier, highest score first."""
    report = anomaly.anomaly_report(layers.scored)
    return anomaly.by_score(
        report.withColumn("anomaly_score", F.round("anomaly_score", 6)), "HIGH"
    )


# --- text and vectors ---------------------------------------------------------------------


@query("history_latest")
def _(layers: Layers) -> DataFrame:
    """The ten most recent events."""
    return retrieval.latest(
        layers.table("events").select("event_id", "ts", "event_type"), "ts", 10, "event_id"
    )


def _policy_documents(layers: Layers) -> DataFrame:
    return layers.dim_policy.select("policy_number", retrieval.labelled_text().alias("text"))


query("policy_text")(_policy_documents)


@query("document_chunks")
def _(layers: Layers) -> DataFrame:
    return retrieval.chunk_documents(layers.table("documents"), "doc_id", "text")


def _label_centroids(layers: Layers) -> DataFrame:
    """One question vector per label: the mean of its vectors."""
    values = layers.table("embeddings").select("label", F.posexplode("embedding").alias("pos", "v"))
    means = values.groupBy("label", "pos").agg(F.avg(F.col("v").cast("double")).alias("mean"))
    rows = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "mean"))).alias("m"))
    return rows.select(F.col("label").alias("question_id"), F.col("m.mean").alias("embedding"))


@query("vector_topk")
def _(layers: Layers) -> DataFrame:
    """The four vectors most similar to the mean vector of each label."""
    found = retrieval.top_k(
        _label_centroids(layers), layers.table("embeddings"), item_id="vec_id"
    )
    return found.select("question_id", "vec_id", "rank", F.round("score", 6).alias("score"))


def _policy_chunks(layers: Layers) -> DataFrame:
    """All chunks of the policy documents, each with one of the given vectors.

    There are more policies than vectors, so numbers are taken modulo the number of vectors.
    """
    vectors = layers.table("embeddings")
    total = vectors.agg(F.count("*")).scalar()
    slots = vectors.select(F.col("vec_id").alias("_slot"), "embedding")
    chunks = retrieval.chunk_documents(_policy_documents(layers), "policy_number", "text")
    number = F.substring("policy_number", 2, 20).cast("long")
    return chunks.withColumn("_slot", F.pmod(number, total)).join(slots, "_slot").drop("_slot")


@query("retrieval_context")
def _(layers: Layers) -> DataFrame:
    """Context, sources and confidence of each label's question over the policy chunks."""
    chunks = _policy_chunks(layers)
    ranked = retrieval.top_k(_label_centroids(layers), chunks, carry=["policy_number", "text"])
    context = retrieval.retrieval_context(ranked, "policy_number")
    return context.withColumn("confidence_score", F.round("confidence_score", 6))


def _asked_of_documents(layers: Layers) -> tuple[DataFrame, DataFrame]:
    """Benchmark texts as questions and document chunks, with vectors of weighted words."""
    chunks = retrieval.chunk_documents(layers.table("documents"), "doc_id", "text")
    questions = layers.table("benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question")
    )
    return retrieval.text_vectors(questions, "question", chunks, "text")


@query("text_vector_topk")
def _(layers: Layers) -> DataFrame:
    """The four document chunks most similar to every benchmark text, by weighted words."""
    found = retrieval.top_k(*_asked_of_documents(layers))
    return found.withColumn("score", F.round("score", 6))


def _question_prompts(layers: Layers) -> DataFrame:
    found = reports.question_prompts(*_asked_of_documents(layers), "doc_id", ANSWER_TEMPLATE)
    return found.withColumn("confidence_score", F.round("confidence_score", 6))


@query("question_answers")
def _(layers: Layers) -> DataFrame:
    """Every benchmark text asked of the document chunks: the prompt that a model would get."""
    return _question_prompts(layers).withColumn("prompt", F.md5(F.col("prompt").cast("binary")))


@query("history_two_batches")
def _(layers: Layers) -> DataFrame:
    """The ten latest questions of a history of two batches, of which the second came twice."""
    path = f"{shared_folder(layers.spark)}/history-{uuid.uuid4().hex}"
    asked = _question_prompts(layers).select("question_id", "confidence_score", "source_policies")
    # Asked once: every batch is a part of the same answers.
    asked.write.parquet(f"{path}-asked")
    asked = layers.spark.read.parquet(f"{path}-asked")
    second = F.col("question_id") % 2 == 1
    for batch, rows in [(1, asked.where(~second)), (2, asked.where(second)), (2, asked.where(second))]:
        stamped = rows.withColumn("timestamp", F.lit(f"2024-01-3{batch - 1} 00:00:00").cast("timestamp"))
        append_batch(stamped, path, batch)
    history = layers.spark.read.parquet(path).drop("_batch_id")
    return retrieval.latest(history, "timestamp", 10, "question_id")


@query("prompt_fill")
def _(layers: Layers) -> DataFrame:
    customers = layers.cleaned("customers")
    prompt = fill_template(
        "Customer {id} works as {job} in {city}, {region}; default flag {flag}.",
        {
            "id": F.col("CustomerID"),
            "job": F.col("Job"),
            "city": F.col("City"),
            "region": F.col("Region"),
            "flag": F.col("Default"),
        },
    )
    return customers.select("CustomerID", prompt.alias("prompt"))


@query("response_text_extract")
def _(layers: Layers) -> DataFrame:
    """Conversation turns wrapped as chat responses (string, block list, or no text) and read back."""
    text = F.col("text")
    as_string = F.to_json(
        F.struct(F.array(F.struct(F.struct(text.alias("content")).alias("message"))).alias("choices"))
    )
    blocks = F.array(
        F.struct(F.lit("reasoning").alias("type"), F.lit("...").alias("text")),
        F.struct(F.lit("text").alias("type"), text.alias("text")),
    )
    as_blocks = F.to_json(
        F.struct(
            F.array(F.struct(F.struct(blocks.alias("content")).alias("message"))).alias("choices")
        )
    )
    response = (
        F.when(F.col("role") == "user", as_string)
        .when(F.col("role") == "assistant", as_blocks)
        .otherwise(F.lit('{"choices": []}'))
    )
    return layers.table("conversations").select(
        "conv_id", "turn", generate.response_text(response).alias("answer")
    )


@query("generated_briefs")
def _(layers: Layers) -> DataFrame:
    """Flagged claims with their brief and the prompt for it."""
    generator = answers.by_rules("To do: ", ", rules ", answers.CHECKS, "nothing")
    briefs = reports.claim_briefs(layers.scored, BRIEF_TEMPLATE, generator, with_prompt=True)
    return briefs.withColumn("anomaly_score", F.round("anomaly_score", 6))


@query("dq_explanations")
def _(layers: Layers) -> DataFrame:
    """Quality issues with their explanation, the state of the call and the prompt for it."""
    generator = answers.by_rules("Likely cause: ", " for '", answers.CAUSES, "not known")
    written = F.lit(RUN_TS).cast("timestamp")
    return reports.issue_explanations(
        layers.issues, ISSUE_TEMPLATE, answers.MODEL, written, generator, with_prompt=True
    )


@query("domain_summaries")
def _(layers: Layers) -> DataFrame:
    """The figures of each domain as JSON, with their summary, the state and the prompt for it."""
    kpis = {
        "Customer Profile": _rounded(kpi.customer_kpis(layers.dim_customers)),
        "Policy Portfolio": _rounded(kpi.policy_kpis(layers.dim_policy)),
        "Claims Performance": _rounded(kpi.claims_kpis(layers.fact_claims)),
    }
    generator = answers.in_words(", in figures: ")
    written = F.lit(RUN_TS).cast("timestamp")
    return reports.domain_summaries(
        kpis, SUMMARY_TEMPLATE, answers.MODEL, written, generator, with_prompt=True
    )


# --- streaming ----------------------------------------------------------------------------


@query("stream_dedup_watermark")
def _(layers: Layers) -> DataFrame:
    """Claims in three batches: repeats dropped by state, late ones by the watermark; no ids."""
    deduped = stream_dedup_table(layers.spark, layers.raw("claims"))
    return deduped.select(*ent.CLAIMS.dedup_columns)


@query("stream_fact_claims")
def _(layers: Layers) -> DataFrame:
    """Claims from landing to facts by streaming steps, which are listed out of order."""
    layers.silver("policy")
    return stream_facts(layers.spark, layers.raw("claims"), layers.stored["policy"])


@query("stream_claims_references")
def _(layers: Layers) -> DataFrame:
    """Streamed claims against policies, of which half arrive between two runs."""
    checked = stream_references(layers.spark, layers.raw("claims"), layers.silver("policy"))
    return checked.select("claim_id", F.col("_route").alias("route"), "error_reason")


@query("audit_stream_runs")
def _(layers: Layers) -> DataFrame:
    """Audit of a log that steps have written: rows in and out, drops, expectations, a failure."""
    log = stream_run_log(layers.spark, layers.raw("cars"))
    runs = audit.audit_metrics(log, F.lit(RUN_TS).cast("timestamp"))
    return runs.select(
        "dataset_name",
        "final_status",
        "total_output_rows",
        "total_dropped_rows",
        F.to_json("expectations").alias("expectations"),
    )


@query("stream_valid_quarantine")
def _(layers: Layers) -> DataFrame:
    """Cars read as a file stream and split by their rules in one pass."""
    routed = stream_split_table(layers.spark, layers.raw("cars"))
    return routed.select("car_id", F.col("_route").alias("route"), "error_reason")


