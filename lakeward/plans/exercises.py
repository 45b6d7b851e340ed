"""File and stream round trips for the catalogue: write test tables out, take them in again.

Files go to a new folder under the shared folder on every call.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.plans import entities as ent
from lakeward.operators import rules
from lakeward.operators.rules import VALID
from lakeward.plans import star
from lakeward.session import release_shuffles
from lakeward.sources.files import ingest_csv, ingest_json, read_bronze
from lakeward.sources.tables import optional_path, shared_folder
from lakeward.streaming.steps import (
    Step,
    dedup_across_runs,
    dedup_stream,
    run_step,
    run_steps,
    split_stream,
    stream_json,
    stream_table,
    unread,
)

# The header variants of the customer files.
CUSTOMER_HEADERS = [
    ["CustomerID", "Region", "State", "City", "Marital", "Edu", "Job", "Balance", "HHInsurance",
     "CarLoan", "Default"],
    ["Customer_ID", "State", "City_in_state", "Reg", "Education", "Marital", "Job", "CarLoan",
     "Default", "HHInsurance", "Balance"],
    ["Balance", "cust_id", "City", "Reg", "State", "Edu", "Job", "Marital_status", "Default",
     "HHInsurance", "CarLoan"],
]
# Names that a URL escapes, one folder for each header variant.
CUSTOMER_FOLDERS = ["customers a", "customers%20b", "customers#c é"]
# The third variant's header goes over two lines.
SPLIT_NAME = "Job\ntitle"
ROWS_PER_DOCUMENT = 5_000
WATERMARK = "1 day"
EARLY = "1995-06-17"
# What is held back is older than the first arrival by far more than the watermark's delay.
HELD = "1995-06-01"
# An arrival is dealt to files of about so many rows, in every arrival as many.
FILES_PER_ARRIVAL = 4
ROWS_PER_FILE = 100_000
LEAST_ROWS_PER_FILE = 1_000
# Other landed files have at most so many.
LANDED_ROWS = 100_000
# Landed text repeats its keys in every record.
PACKED = {"compression": "gzip"}


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _run_ts():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def _write_csv(df: DataFrame, path: str) -> None:
    """CSV that keeps padding and tells empty text from null."""
    writer = df.write.option("header", True).option("nullValue", "").option("emptyValue", '""')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)


def _land_json(rows: DataFrame, path: str) -> None:
    """JSON lines as they land, packed; what the rows were shuffled for is not kept.

    A packed file is read by one task, so none is large.
    """
    rows.write.options(**PACKED, maxRecordsPerFile=LANDED_ROWS).json(path)
    release_shuffles(rows.sparkSession)


def csv_drift_table(spark: SparkSession, customers: DataFrame) -> DataFrame:
    """Each customer goes to the file set whose alias column it fills."""
    landing, bronze = _new_folder(spark, "landing"), _new_folder(spark, "bronze")
    for header, folder in zip(CUSTOMER_HEADERS, CUSTOMER_FOLDERS, strict=True):
        key = next(c for c in header if c in ("CustomerID", "Customer_ID", "cust_id"))
        rows = customers.where(F.col(key).isNotNull()).select(*header)
        if key == "cust_id":
            rows = rows.withColumnRenamed("Job", SPLIT_NAME)
        _write_csv(rows, f"{landing}/{folder}")
    ingest_csv(spark, landing, "part-*.csv", bronze, _run_ts(), path_word="customers")
    return read_bronze(spark, bronze).withColumn("Job", F.coalesce("Job", F.col(f"`{SPLIT_NAME}`")))


def incremental_table(spark: SparkSession, cars: DataFrame) -> DataFrame:
    """Three drops of files, each followed by a load; a last load finds nothing new."""
    landing, bronze = _new_folder(spark, "landing"), _new_folder(spark, "bronze")
    drops = [F.col("fuel").isNull(), F.col("fuel").rlike("(?i)petrol"), None]
    rest = cars
    for number, condition in enumerate(drops):
        part = rest if condition is None else rest.where(F.coalesce(condition, F.lit(False)))
        if condition is not None:
            rest = rest.where(~F.coalesce(condition, F.lit(False)))
        _write_csv(part, f"{landing}/cars_{number}")
        ingest_csv(spark, landing, "part-*.csv", bronze, _run_ts(), path_word="cars")
    again = ingest_csv(spark, landing, "part-*.csv", bronze, _run_ts(), path_word="cars")
    if again:
        raise AssertionError(f"{again} files were loaded twice")
    return read_bronze(spark, bronze)


def json_table(spark: SparkSession, claims: DataFrame) -> DataFrame:
    """Claims as pretty-printed JSON arrays of bounded size; two keys per row are undeclared.

    They arrive in two loads: in the first ``incident_location`` is an object and an undeclared
    key a number, in the second both are text.
    """
    landing, bronze = _new_folder(spark, "landing"), _new_folder(spark, "bronze")
    fields = claims.columns
    extra = claims.withColumns(
        {
            "adjuster": F.when(F.col("property_damage") == "?", F.col("incident_city")),
            "Notes": F.when(F.col("witnesses") == "0", F.lit("none seen")),
        }
    )
    early = F.col("bodily_injuries") == "0"
    place = F.struct(F.col("incident_location").alias("place"))
    first = extra.where(early).withColumns({"incident_location": place, "Notes": F.length("Notes")})
    second = extra.where(F.coalesce(~early, F.lit(True)))
    for number, rows in enumerate([first, second]):
        _write_documents(rows, f"{landing}/claims {number}")
        ingest_json(spark, landing, "part-*.txt*", bronze, fields, _run_ts(), path_word="claims")
    return read_bronze(spark, bronze)


def _write_documents(rows: DataFrame, path: str) -> None:
    """One packed file per document, an array of at most ``ROWS_PER_DOCUMENT`` records.

    Narrow: a task joins the records that it has anyway, and a file takes one document.
    """
    records = rows.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("r"))
    documents = records.mapInArrow(_documents, "value string")
    documents.write.options(**PACKED, maxRecordsPerFile=1).text(path)
    release_shuffles(rows.sparkSession)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records as JSON arrays: what comes in a batch, cut by ``ROWS_PER_DOCUMENT``."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_PER_DOCUMENT):
            own = batch.column(0).slice(start, ROWS_PER_DOCUMENT)
            whole = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
            text = pc.binary_join_element_wise("[\n", pc.binary_join(whole, ",\n"), "\n]", "")
            yield pa.RecordBatch.from_arrays([text], ["value"])


def stream_dedup_table(spark: SparkSession, claims: DataFrame) -> DataFrame:
    """Three arrivals in one run, a batch each, with a watermark of one day behind the newest.

    First the claims up to ``EARLY``, then those after it.  Last come claims held back from the
    first arrival, which are late by then and lost, and the newest day's claims once more, which
    state still knows.
    """
    root = _new_folder(spark, "stream")
    early = F.col("incident_date") < EARLY
    held = (F.col("incident_date") < HELD) & (F.col("number_of_vehicles_involved") == "3")
    newest, *counts = claims.agg(
        F.max("incident_date"), F.count_if(early & ~held), F.count_if(~early), F.count_if(held)
    ).first()
    again = F.col("incident_date") == F.lit(newest)
    # A batch is told by its number of files, so no file of the smallest arrival may be empty.
    files = min(max(counts) // ROWS_PER_FILE, min(counts) // LEAST_ROWS_PER_FILE)
    files = max(FILES_PER_ARRIVAL, files)
    for number, rows in enumerate(
        [claims.where(early & ~held), claims.where(~early), claims.where(held | again)]
    ):
        # Not by ``_land_json``: a file more would be a batch more.
        rows.repartition(files).write.options(**PACKED).json(f"{root}/landing/claims_{number}")
        release_shuffles(spark)
    schema = ", ".join(f"{c} string" for c in claims.columns)
    step = Step(
        "silver",
        lambda s: dedup_stream(
            ent.clean_claims(stream_json_lines(s, f"{root}/landing", schema, files)),
            "incident_date",
            WATERMARK,
            ent.CLAIMS.dedup_columns,
        ),
        f"{root}/silver",
    )
    run_steps(spark, [step], f"{root}/checkpoints", f"{root}/log")
    return spark.read.parquet(f"{root}/silver")


def _claims_step(root: str, policy_path: str, inputs: list[str]) -> Step:
    """Claims of bronze, split by their rules; policies are read anew for every run."""

    def build(s: SparkSession) -> DataFrame:
        raw = stream_table(s, f"{root}/bronze")
        refs = {"policy": s.read.parquet(policy_path)}
        coming = unread(s, f"{root}/bronze", f"{root}/checked")
        return split_stream(ent.CLAIMS, raw, refs, coming)

    return Step("checked", build, f"{root}/checked", ["_route"], inputs)


def _bronze_step(root: str, schema: str) -> Step:
    return Step(
        "bronze", lambda s: stream_json_lines(s, f"{root}/landing", schema), f"{root}/bronze"
    )


def stream_facts(spark: SparkSession, claims: DataFrame, policy_path: str) -> DataFrame:
    """Landing to facts in four steps, listed from the last to the first, over two runs.

    The second run brings claims again under other ids: none becomes a fact twice.
    """
    root = _new_folder(spark, "stream")
    schema = ", ".join(f"{c} string" for c in claims.columns)
    columns = ent.CLAIMS.dedup_columns

    def silver(s: SparkSession) -> DataFrame:
        kept = stream_table(s, f"{root}/checked").where(F.col("_route") == VALID).drop("_route")
        return dedup_across_runs(kept, optional_path(s, f"{root}/silver"), columns, columns)

    def facts(s: SparkSession) -> DataFrame:
        coming = unread(s, f"{root}/silver", f"{root}/facts")
        claims, policy = stream_table(s, f"{root}/silver"), s.read.parquet(policy_path)
        return star.fact_claims(claims, policy, coming)

    steps = [
        Step("facts", facts, f"{root}/facts", inputs=["silver"]),
        Step("silver", silver, f"{root}/silver", inputs=["checked"]),
        _claims_step(root, policy_path, ["bronze"]),
        _bronze_step(root, schema),
    ]
    for number, rows in enumerate(
        [claims.where(~F.col("ClaimID").endswith("R")), claims.where(F.col("ClaimID").endswith("R"))]
    ):
        _land_json(rows, f"{root}/landing/claims_{number}")
        run_steps(spark, steps, f"{root}/checkpoints", f"{root}/log")
    return spark.read.parquet(f"{root}/facts")


def stream_references(spark: SparkSession, claims: DataFrame, policy: DataFrame) -> DataFrame:
    """Claims in two runs; policies of odd numbers arrive between them."""
    root = _new_folder(spark, "stream")
    schema = ", ".join(f"{c} string" for c in claims.columns)
    steps = [
        _claims_step(root, f"{root}/policy", ["bronze", "policy"]),
        Step("policy", lambda s: stream_table(s, f"{root}/arrived"), f"{root}/policy"),
        _bronze_step(root, schema),
    ]
    odd = F.col("policy_number").substr(F.lit(2), F.lit(20)).cast("long") % 2 == 1
    first = F.col("bodily_injuries") == "0"
    arrivals = [
        (claims.where(first), policy.where(~odd)),
        (claims.where(~first), policy.where(odd)),
    ]
    for number, (some, known) in enumerate(arrivals):
        _land_json(some, f"{root}/landing/claims_{number}")
        known.write.mode("append").parquet(f"{root}/arrived")
        run_steps(spark, steps, f"{root}/checkpoints", f"{root}/log")
    return spark.read.parquet(f"{root}/checked")


def stream_run_log(spark: SparkSession, cars: DataFrame) -> DataFrame:
    """The log of a run whose steps drop rows, and whose last one fails."""
    root = _new_folder(spark, "stream")
    cars.write.json(f"{root}/landing/cars")
    schema = ", ".join(f"{c} string" for c in cars.columns)

    def silver(s: SparkSession) -> DataFrame:
        cleaned = ent.clean_cars(stream_table(s, f"{root}/bronze"))
        return rules.keep(rules.observed(cleaned, ent.CAR_RULES, "cars"), ent.CAR_RULES)

    def broken(s: SparkSession) -> DataFrame:
        rows = stream_table(s, f"{root}/silver")
        return rows.select(F.raise_error(F.lit("refused")).cast("string").alias("none"))

    steps = [
        Step("broken", broken, f"{root}/broken", inputs=["silver"]),
        Step("silver", silver, f"{root}/silver", inputs=["bronze"]),
        _bronze_step(root, schema),
    ]
    try:
        run_steps(spark, steps, f"{root}/checkpoints", f"{root}/log")
    except StreamingQueryException:
        return spark.read.parquet(f"{root}/log")
    raise AssertionError("the last step was to fail")


def stream_json_lines(
    spark: SparkSession, landing: str, schema: str, files_per_batch: int | None = None
) -> DataFrame:
    """JSON lines as written by Spark, packed or not: one record per line."""
    return stream_json(
        spark, landing, schema, "part-*.json*", _run_ts(), multi_line=False,
        files_per_batch=files_per_batch,
    )


def stream_split_table(spark: SparkSession, cars: DataFrame) -> DataFrame:
    root = _new_folder(spark, "stream")
    cars.write.json(f"{root}/landing/cars")
    schema = ", ".join(f"{c} string" for c in cars.columns)
    step = Step(
        "cars",
        lambda s: split_stream(
            ent.CARS, stream_json_lines(s, f"{root}/landing", schema), refs=None
        ),
        f"{root}/silver",
        partition_by=["_route"],
    )
    run_step(spark, step, f"{root}/checkpoints")
    return spark.read.parquet(f"{root}/silver")
