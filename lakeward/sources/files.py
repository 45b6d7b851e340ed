"""Incremental file ingest with header drift, rescue and lineage.

A small ledger next to bronze names the files that have been read, also those without rows.
Every load has a number, one more than the ledger's last, and its rows and its ledger entries are
a partition of that number each.  The ledger is written after the rows: a run that fails between
the two leaves rows of a load that the ledger does not know, and the next run has the same
number and writes that partition anew.  No row is lost or doubled.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.sources.tables import LOAD, optional_path, write_load

RESCUED = "_rescued_data"
SOURCE = "_source_file"
LOADED = "_load_ts"
FILES_PER_LOAD = 10_000
LEDGER = "_ledger"
# A file of more bytes is not read whole for its header, but some lines at a time.
PROBE_BYTES = 1 << 19
PROBE_LINES = 64
# Files whose first lines are read at the same time.
PROBES = 16
LONGEST_HEADER = 1 << 20
# Which files belong to which entity, whatever the case of their names.
FILE_GLOBS = {
    "customers": "[cC][uU][sS][tT][oO][mM][eE][rR][sS]*.csv",
    "sales": "[sS][aA][lL][eE][sS]*.csv",
    "claims": "[cC][lL][aA][iI][mM][sS]*.json",
    "policy": "[pP][oO][lL][iI][cC][yY]*.csv",
    "cars": "[cC][aA][rR][sS]*.csv",
}


def list_files(
    spark: SparkSession, source_dir: str, glob: str, path_word: str | None = None
) -> DataFrame:
    """(path, _source_file, modificationTime, length) of matching files at any depth; no content
    is read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(source_dir)
        .select("path", F.col("_metadata.file_path").alias(SOURCE), "modificationTime", "length")
    )
    if path_word:
        files = files.where(F.lower(SOURCE).contains(path_word.lower()))
    return files


def new_files(files: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Files that the ledger doesn't name yet."""
    if ledger is None:
        return files
    return files.join(ledger.select(SOURCE).distinct(), SOURCE, "left_anti")


def _ledger_path(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}{LEDGER}"


def _next_load(ledger: DataFrame | None) -> int:
    """The number of the next load: that of a load which the ledger does not know, if one failed."""
    last = ledger.agg(F.max(LOAD)).first()[0] if ledger is not None else None
    return 1 if last is None else last + 1


def _literal(path: str) -> str:
    """A path that Spark's readers take as it is, not as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _quote_is_open(text: str, sep: str) -> bool:
    """Whether a quoted name has not ended; quotes inside an unquoted name are letters."""
    quoted, begins, closed = False, True, False
    for letter in text:
        if quoted:
            quoted, closed = letter != '"', letter == '"'
        elif letter == '"' and (begins or closed):
            quoted = True
        else:
            closed = False
        begins = not quoted and not closed and letter == sep
    return quoted


def _first_record(lines: Iterator[str], sep: str) -> str | None:
    """The first line with any text, and what follows until its quotes are closed.

    A quote that stays open for ``LONGEST_HEADER`` characters is a letter of the first line.
    """
    lines = (line.removeprefix("\ufeff") for line in lines)
    first = next((line for line in lines if line.strip()), None)
    record = first
    while record is not None and _quote_is_open(record, sep):
        more = next(lines, None)
        if more is None or len(record) + len(more) > LONGEST_HEADER:
            return first
        record += "\n" + more
    return record


def _headers(batches: Iterator[pa.RecordBatch], sep: str) -> Iterator[pa.RecordBatch]:
    """(file, start, header) of every split of a task."""
    lines = (row for batch in batches for row in zip(*map(pa.Array.to_pylist, batch.columns)))
    for (file, start), own in groupby(lines, key=lambda row: row[1:]):
        header = _first_record((line for line, *_ in own), sep)
        yield pa.RecordBatch.from_pydict({"file": [file], "start": [start], "header": [header]})


def _small_headers(spark: SparkSession, files: dict[str, str], sep: str) -> dict[str, str]:
    """Headers of files that are read whole, in one job."""
    lines = spark.read.text([_literal(p) for p in files.values()]).select(
        "value", "_metadata.file_path", "_metadata.file_block_start"
    )
    found = lines.mapInArrow(
        lambda batches: _headers(batches, sep), "file string, start long, header string"
    )
    first: dict[str, tuple[int, str]] = {}
    for row in found.where("header IS NOT NULL").collect():
        own = (row["start"], row["header"])
        first[row["file"]] = min(own, first.get(row["file"], own))
    return {files[file]: header for file, (_, header) in first.items()}


def _large_header(spark: SparkSession, path: str, sep: str) -> str | None:
    """The header of one file: a limit stops its first task after some lines."""
    lines = spark.read.text(_literal(path)).where("_metadata.file_block_start = 0").select("value")
    wanted = PROBE_LINES
    while True:
        found = [row["value"] for row in lines.limit(wanted).collect()]
        header = _first_record(iter(found), sep)
        if len(found) < wanted or (header is not None and not _quote_is_open(header, sep)):
            return header
        wanted *= 16


def probe_headers(
    spark: SparkSession, files: DataFrame | Sequence[Row], sep: str = ","
) -> dict[str, str]:
    """{path: header} of those ``files`` (rows of :func:`list_files`) that have any text.

    A header is the first record: a quoted name may hold line breaks.  Files of up to
    ``PROBE_BYTES`` are read in one job; of a larger one a task reads some lines and stops, so no
    file costs more than that, whatever its size.  Lines are read by Spark, so any file system
    that Spark knows will do.
    """
    rows = files.collect() if isinstance(files, DataFrame) else files
    small = {r[SOURCE]: r["path"] for r in rows if r["length"] <= PROBE_BYTES}
    large = [r["path"] for r in rows if r["length"] > PROBE_BYTES]
    found = _small_headers(spark, small, sep) if small else {}
    with ThreadPoolExecutor(PROBES) as pool:
        headers = pool.map(lambda path: _large_header(spark, path, sep), large)
        found |= {p: h for p, h in zip(large, headers, strict=True) if h is not None}
    return found


def header_schema(header: str, sep: str = ",") -> T.StructType:
    """All-text schema in the order of one header line, plus the rescue column."""
    names: list[str] = []
    for position, name in enumerate(next(csv.reader([header], delimiter=sep), [])):
        name = name.strip() or f"_c{position}"
        taken = {n.lower() for n in names}
        names.append(name if name.lower() not in taken else f"{name}_{position}")
    fields = [T.StructField(n, T.StringType()) for n in [*names, RESCUED]]
    return T.StructType(fields)


def lineage(run_ts: Column) -> dict[str, Column]:
    return {SOURCE: F.col("_metadata.file_path"), LOADED: run_ts}


def _read_csv(spark: SparkSession, paths: list[str], header: str, run_ts: Column, sep: str):
    return (
        spark.read.schema(header_schema(header, sep))
        .option("header", True)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        # A file whose header goes over lines cannot be split at lines.
        .option("multiLine", "\n" in header)
        .option("columnNameOfCorruptRecord", RESCUED)
        .csv([_literal(p) for p in paths])
        .withColumns(lineage(run_ts))
    )


def read_csv_by_header(
    spark: SparkSession, files: Sequence[Row], run_ts: Column, sep: str = ","
) -> DataFrame | None:
    """Rows of all ``files`` with columns bound by name; None when none has a header.

    Files with equal headers are read together under that header's schema, since one
    reader over mixed headers binds by position.  Rows that do not fit their header
    keep their text in ``_rescued_data``.  Blank lines before the header are skipped; a file
    without any text has no rows.  Only file names and headers reach the driver, for at most
    the files of one load.
    """
    by_header: dict[str, list[str]] = {}
    for path, header in probe_headers(spark, files, sep).items():
        by_header.setdefault(header, []).append(path)
    if not by_header:
        return None
    frames = [_read_csv(spark, group, h, run_ts, sep) for h, group in sorted(by_header.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def json_records(texts: DataFrame, schema: str) -> DataFrame:
    """Records of JSON texts: the columns of ``schema``, the rest in ``_rescued_data``.

    ``texts`` has a column ``value`` with one object or an array of objects; its other columns
    are carried along.  A declared key of type string takes any value: text as it is, an object
    or array as its JSON.  So a key may hold an object in one file and text in the next, and
    nothing is inferred from the data.  ``_rescued_data`` is a JSON object of all other keys with
    their values as they are (see :func:`rescued`); a text that is no JSON is one row with the
    text under ``_broken``.  A blank text has no row.
    """
    value, names = F.col("value"), T.DataType.fromDDL(schema).names
    carried = [c for c in texts.columns if c != "value"]
    declared = F.from_json(value, f"array<struct<{schema}>>")
    # Most objects have declared keys only: then there is nothing to look for in them again.
    undeclared = F.array_except(F.json_object_keys(value), F.array(*map(F.lit, names)))
    every = (
        F.when(value.rlike(r"^\s*\["), F.from_json(value, "array<map<string, variant>>"))
        .when(F.size(undeclared) == 0, F.array(F.lit(None).cast("map<string, variant>")))
        .otherwise(F.array(F.from_json(value, "map<string, variant>")))
    )
    parsed = texts.where(value.rlike(r"\S")).select(
        *carried, declared.alias("_declared"),
        F.coalesce(every, F.array().cast("array<map<string, variant>>")).alias("_every"),
        F.to_json(F.struct(value.alias("_broken"))).alias("_broken"),
    )
    # What is exploded must not come along with every record: first the mark, then the records.
    marked = parsed.select(
        *carried,
        F.when(F.col("_declared").isNull(), F.col("_broken")).alias("_broken"),
        F.arrays_zip("_declared", "_every").alias("_records"),
    )
    rows = marked.select(*carried, "_broken", F.explode_outer("_records").alias("_record"))
    # An empty array has no records; a text that cannot be parsed is one.
    rows = rows.where(F.col("_record").isNotNull() | F.col("_broken").isNotNull())
    fields, others = F.col("_record._declared"), F.col("_record._every")
    others = F.map_filter(others, lambda key, _: ~key.isin(names))
    others = F.nullif(F.to_json(others, {"ignoreNullFields": "true"}), F.lit("{}"))
    return rows.select(
        *[fields.getField(n).alias(n) for n in names],
        F.coalesce("_broken", others).alias(RESCUED),
        *carried,
    )


def rescued(key: str, kind: str = "string") -> Column:
    """The value of a key in ``_rescued_data``, or null: text, or any type it can be cast to."""
    path = "$['" + key.replace("\\", "\\\\").replace("'", "\\'") + "']"
    return F.try_variant_get(F.try_parse_json(RESCUED), path, kind)


def read_json_rescued(
    spark: SparkSession,
    paths: list[str],
    fields: list[str],
    run_ts: Column,
    multi_line: bool = True,
) -> DataFrame:
    """Declared fields as text; undeclared keys and broken records go to ``_rescued_data``.

    With ``multi_line`` a file is one text, an object or an array, and is parsed by one task;
    otherwise every line is a text.
    """
    texts = spark.read.text([_literal(p) for p in paths], wholetext=multi_line)
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in fields)
    return json_records(texts.withColumns(lineage(run_ts)), schema)


def _loads(pending: DataFrame, limit: int) -> Iterator[list[Row]]:
    """The pending files, oldest first, at most ``limit`` at a time until all are out."""
    position = F.struct("modificationTime", "path")
    after = None
    while True:
        rest = pending
        if after is not None:
            last = F.struct(
                F.lit(after["modificationTime"]).alias("modificationTime"),
                F.lit(after["path"]).alias("path"),
            )
            rest = pending.where(position > last)
        rows = rest.orderBy(position).limit(limit).collect()
        if not rows:
            return
        yield rows
        after = rows[-1]


def _ingest(
    spark: SparkSession,
    files: DataFrame,
    bronze_path: str,
    run_ts: Column,
    files_per_load: int,
    read: Callable[[Sequence[Row]], DataFrame | None],
) -> int:
    """Store every file that the ledger does not name; returns their number."""
    ledger_path = _ledger_path(bronze_path)
    ledger = optional_path(spark, ledger_path)
    load, loaded = _next_load(ledger), 0
    for rows in _loads(new_files(files, ledger), files_per_load):
        found = read(rows)
        if found is not None:
            write_load(found, bronze_path, load)
        entries = spark.createDataFrame(
            [(r[SOURCE], r["modificationTime"]) for r in rows],
            f"{SOURCE} string, modificationTime timestamp",
        )
        write_load(entries.withColumn(LOADED, run_ts), ledger_path, load)
        load, loaded = load + 1, loaded + len(rows)
    return loaded


def ingest_csv(
    spark: SparkSession,
    source_dir: str,
    glob: str,
    bronze_path: str,
    run_ts: Column,
    path_word: str | None = None,
    files_per_load: int = FILES_PER_LOAD,
) -> int:
    """Append every new CSV file to bronze; returns the number of files read.

    Works in loads of at most ``files_per_load`` files until all are in, so the file
    list on the driver stays bounded.  New columns widen the table, whose readers
    merge the schemas of its files (:func:`read_bronze`).
    """
    files = list_files(spark, source_dir, glob, path_word)
    return _ingest(
        spark, files, bronze_path, run_ts, files_per_load,
        lambda rows: read_csv_by_header(spark, rows, run_ts),
    )


def ingest_json(
    spark: SparkSession,
    source_dir: str,
    glob: str,
    bronze_path: str,
    fields: list[str],
    run_ts: Column,
    path_word: str | None = None,
    files_per_load: int = FILES_PER_LOAD,
) -> int:
    """Append every new multi-line JSON file to bronze; returns the number of files read."""
    files = list_files(spark, source_dir, glob, path_word)
    return _ingest(
        spark, files, bronze_path, run_ts, files_per_load,
        lambda rows: read_json_rescued(spark, [r["path"] for r in rows], fields, run_ts),
    )


def read_bronze(spark: SparkSession, path: str) -> DataFrame | None:
    """The bronze table with all columns seen so far, or None before the first load."""
    table = optional_path(spark, path, merge_schema=True)
    return None if table is None else table.drop(LOAD)
