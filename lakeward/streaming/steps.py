"""Streaming steps: read what is new, transform, append to a file table, stop.

Steps use the built-in file sink, whose log makes every append exactly once, and
``availableNow``, so a step handles all input present at its start and ends.  The
plan is built anew for each run: lookups joined to the stream are as fresh as the
start of the run.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.operators.dedup import dedup_against
from lakeward.operators.rules import QUARANTINE, VALID, route
from lakeward.plans.entities import Entity, checked
from lakeward.session import release_shuffles
from lakeward.sources.files import RESCUED, json_records, lineage
from lakeward.sources.tables import STORED, optional_path

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# What stands for the compared columns of a row while repeats are dropped.
_DIGEST = "_digest"
# Times inside arrays and structs, to the microsecond.
_WHOLE_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


# --- sources ------------------------------------------------------------------------------


def stream_csv(
    spark: SparkSession, source_dir: str, schema: str, glob: str, run_ts: Column
) -> DataFrame:
    """New CSV files of one header; files that drift go through ``sources.files``."""
    return (
        spark.readStream.schema(f"{schema}, {RESCUED} string")
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", RESCUED)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .csv(source_dir)
        .withColumns(lineage(run_ts))
    )


def stream_json(
    spark: SparkSession,
    source_dir: str,
    schema: str,
    glob: str,
    run_ts: Column,
    multi_line: bool = True,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New JSON files: declared fields by name, undeclared keys and broken records rescued.

    With ``files_per_batch`` what is new goes through in several batches, oldest files first.
    """
    reader = spark.readStream.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return json_records(reader.text(source_dir, wholetext=multi_line).withColumns(lineage(run_ts)), schema)


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """A table written by an earlier step, as a stream of its new rows."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def unread(spark: SparkSession, path: str, target: str) -> DataFrame | None:
    """Rows of the table at ``path`` in files newer than any of ``target``.

    About what a step from one to the other is going to read, for counts that steer a plan; a
    file more or less changes no result.  Files are chosen by their time, without reading them.
    """
    table = optional_path(spark, path)
    done = optional_path(spark, target)
    if table is None or done is None:
        return table
    newest = done.agg(F.max("_metadata.file_modification_time")).first()[0]
    if newest is None:
        return table
    return table.where(F.col("_metadata.file_modification_time") > F.lit(newest))


# --- transformations ----------------------------------------------------------------------


def split_stream(
    entity: Entity,
    raw: DataFrame,
    refs: dict[str, DataFrame] | None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Every row once, with its route and reason: one evaluation feeds both tables.

    References are tables as they are when the step is built, so a later run finds what has
    arrived since.  ``stored``: see :func:`unread` and ``entities.checked``.
    """
    routed = route(checked(entity, raw, refs, stored), entity.rules)
    carried = [c for c in ("_load_ts",) if c in routed.columns]
    columns = dict.fromkeys([*entity.columns, *entity.quarantine_columns, *carried])
    return routed.select(*columns, "error_reason", "_route")


def routed_table(spark: SparkSession, path: str, side: str) -> DataFrame:
    """One side of a split table; the other side's files are not read."""
    return spark.read.parquet(path).where(F.col("_route") == side).drop("_route")


def dedup_stream(df: DataFrame, time: str, delay: str, columns: Sequence[str]) -> DataFrame:
    """Drop repeats whose event time is at most ``delay`` behind the newest seen.

    State is bounded by the delay.  Rows older than it are dropped one batch later,
    rows without an event time are always taken; a backfill needs a delay that
    spans it, or the keyed duplicate removal of the batch operators.

    State holds the time and a digest of all ``columns``, not the columns: their width costs
    nothing there, nor in the checkpoints.
    """
    key = [time] if time in columns else []
    keyed = df.withColumn(_DIGEST, _content(df, columns)).withWatermark(time, delay)
    return keyed.dropDuplicates([*key, _DIGEST]).drop(_DIGEST)


def _content(df: DataFrame, columns: Sequence[str]) -> Column:
    """16 bytes that are equal for rows that agree in all ``columns``, nulls included.

    A digest cut to 128 bits: of 10^12 rows that differ, two meet with a chance of 10^-15.
    """
    times = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    named = [
        (F.unix_micros(f"`{c}`") if c in times else F.col(f"`{c}`")).alias(c) for c in columns
    ]
    return F.substring(F.unhex(F.sha2(F.to_json(F.struct(*named), _WHOLE_TIMES), 256)), 1, 16)


def dedup_across_runs(
    df: DataFrame,
    existing: DataFrame | None,
    columns: Sequence[str],
    stored_columns: Sequence[str],
    load_ts: str = "_load_ts",
    delay: str = "1 hour",
) -> DataFrame:
    """Repeats within a run by state, repeats of earlier runs by an anti join to the target.

    ``load_ts`` is constant within a run, so state holds a run's keys until later runs
    move the watermark past them, when the target already covers them: exact, and the
    state never outgrows the last runs.  A key in state is a digest of the ``columns``.
    """
    if existing is not None:
        df = dedup_against(df, existing, list(stored_columns))
    keyed = df.withColumn(_DIGEST, _content(df, columns)).withWatermark(load_ts, delay)
    return keyed.dropDuplicatesWithinWatermark([_DIGEST]).drop(_DIGEST)


# --- running ------------------------------------------------------------------------------

WRITTEN = "rows_written"
# Seconds between two looks at the batches that a running step has finished.  Spark keeps the
# last hundred, far more than a step finishes in that time.
POLL_SECONDS = 1


@dataclass(frozen=True)
class Step:
    """``build`` returns the streaming frame to append to ``path``; ``inputs`` are the names of
    the steps whose tables it reads.
    """

    name: str
    build: Callable[[SparkSession], DataFrame]
    path: str
    partition_by: list[str] = field(default_factory=list)
    inputs: list[str] = field(default_factory=list)


def ordered(steps: Sequence[Step]) -> list[Step]:
    """Every step after its inputs, else in the given order.

    Names that repeat, inputs that are no step and steps that wait for each other are errors.
    """
    names = [step.name for step in steps]
    if len(set(names)) < len(names):
        raise ValueError(f"steps of one name: {names}")
    if unknown := {i for step in steps for i in step.inputs}.difference(names):
        raise ValueError(f"inputs that are no step: {sorted(unknown)}")
    left, done = list(steps), []
    while left:
        ready = next((s for s in left if {d.name for d in done}.issuperset(s.inputs)), None)
        if ready is None:
            raise ValueError(f"steps that wait for each other: {[s.name for s in left]}")
        done.append(ready)
        left.remove(ready)
    return done


def _started(spark: SparkSession, step: Step, checkpoint_root: str):
    # State lives off the heap, whatever the session's default.
    spark.conf.set(STATE_PROVIDER, ROCKSDB)
    # The file sink itself reports no number of rows.
    writer = (
        step.build(spark)
        .observe(WRITTEN, F.count(F.lit(1)).alias("rows"))
        .writeStream.format("parquet")
        .outputMode("append")
        .queryName(step.name)
        .option("path", step.path)
        .options(**STORED)
        .option("checkpointLocation", f"{checkpoint_root}/{step.name}")
        .trigger(availableNow=True)
    )
    if step.partition_by:
        writer = writer.partitionBy(*step.partition_by)
    return writer.start()


def finished_batches(
    spark: SparkSession, step: Step, checkpoint_root: str, poll: float = POLL_SECONDS
) -> Iterator[list[dict]]:
    """Run a step; yields the progress of its batches as they finish, some at a time.

    When a batch fails, what finished before it comes first, then the error.
    """
    running = _started(spark, step, checkpoint_root)
    last, error, ended = None, None, False
    while not ended:
        try:
            ended = running.awaitTermination(poll)
        except StreamingQueryException as failure:
            error, ended = failure, True
        recent = [json.loads(p.json) for p in running.recentProgress]
        fresh = [p for p in recent if last is None or (p["batchId"], p["timestamp"]) > last]
        if fresh:
            last = fresh[-1]["batchId"], fresh[-1]["timestamp"]
            yield fresh
    if error is not None:
        raise error


def run_step(spark: SparkSession, step: Step, checkpoint_root: str) -> list[dict]:
    """Append everything new to the step's table; returns the progress of its batches."""
    return [p for some in finished_batches(spark, step, checkpoint_root) for p in some]


def run_steps(
    spark: SparkSession, steps: Sequence[Step], checkpoint_root: str, log_path: str | None = None
) -> None:
    """Run steps in the order of their inputs, so each one reads what the ones before it wrote.

    The log grows while a step runs: a driver that is lost leaves the batches finished by then.
    A step that fails is logged as FAILED after them, and its error ends the run.
    """

    def log(rows: DataFrame) -> None:
        if log_path:
            rows.write.mode("append").parquet(log_path)

    for step in ordered(steps):
        try:
            for batches in finished_batches(spark, step, checkpoint_root):
                log(run_log(spark, step.name, batches))
        except Exception:
            log(failed_log(spark, step.name))
            raise
        release_shuffles(spark)


# --- run log ------------------------------------------------------------------------------

LOG_SCHEMA = (
    "origin struct<pipeline_id: string, pipeline_name: string, update_id: string, "
    "flow_name: string>, event_type string, timestamp timestamp, details string"
)


def run_log(spark: SparkSession, flow: str, progress: Sequence[dict]) -> DataFrame:
    """Event log rows (the input of the audit) from the progress of one step's batches.

    Counters collected with ``rules.observed`` become the expectations of the flow.  Dropped
    are the rows read that were not written: by a rule, as duplicates or as late.
    """
    rows = []
    for batch in progress:
        observed = dict(batch.get("observedMetrics") or {})
        read = batch.get("numInputRows", 0)
        written = (observed.pop(WRITTEN, None) or {}).get("rows", 0)
        details = {
            "status": "COMPLETED",
            "metrics": {"num_output_rows": written},
            "data_quality": {
                "dropped_records": max(read - written, 0),
                "expectations": _expectations(flow, observed),
            },
        }
        at = datetime.datetime.fromisoformat(batch["timestamp"].replace("Z", "+00:00"))
        rows.append(_log_row(batch["id"], flow, batch["runId"], at, details))
    return spark.createDataFrame(rows, LOG_SCHEMA)


def failed_log(spark: SparkSession, flow: str) -> DataFrame:
    """One event log row for a step that ended with an error."""
    now, run = datetime.datetime.now(datetime.timezone.utc), uuid.uuid4().hex
    return spark.createDataFrame([_log_row(None, flow, run, now, {"status": "FAILED"})], LOG_SCHEMA)


def _log_row(pipeline: str | None, flow: str, run: str, at: datetime.datetime, details: dict):
    origin = (pipeline, flow, run, flow)
    return origin, "flow_progress", at, json.dumps({"flow_progress": details})


def _expectations(flow: str, observed: dict) -> list[dict]:
    found = []
    for counters in observed.values():
        for name in [n.removesuffix("__passed") for n in counters if n.endswith("__passed")]:
            found.append(
                {
                    "name": name,
                    "dataset": flow,
                    "passed_records": counters[f"{name}__passed"],
                    "failed_records": counters[f"{name}__failed"],
                }
            )
    return found


def valid_side(spark: SparkSession, path: str) -> DataFrame | None:
    """The valid rows stored so far, or None before the first run."""
    stored = optional_path(spark, path)
    return None if stored is None else stored.where(F.col("_route") == VALID)


def quarantine_side(spark: SparkSession, path: str) -> DataFrame | None:
    stored = optional_path(spark, path)
    return None if stored is None else stored.where(F.col("_route") == QUARANTINE)
