"""Table readers and sinks."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="lakeward-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def optional_table(spark: SparkSession, name: str) -> DataFrame | None:
    """The table when it exists; None on a first run.  Other errors are not hidden."""
    return spark.read.table(name) if spark.catalog.tableExists(name) else None


def optional_path(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame | None:
    """Parquet at ``path`` when there is any; other errors are not hidden."""
    try:
        return spark.read.option("mergeSchema", merge_schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def query(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """SQL over frames given by name, next to the tables of the catalog."""
    return spark.sql(sql, **views)


# The partition column of tables that are written load by load.
LOAD = "_load_id"
# Stored tables that only Spark reads again: about two thirds of what Spark's default takes.
STORED = {"compression": "zstd"}


def write_load(rows: DataFrame, path: str, load: int, partition_by: Sequence[str] = ()) -> None:
    """The partition of one load; written again, it replaces itself."""
    writer = rows.write.mode("overwrite").options(**STORED)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{LOAD}={load}")


def append_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch as partition ``_batch_id``; writing it again replaces it."""
    (
        df.withColumn("_batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_batch_id")
        .parquet(path)
    )


def refresh(df: DataFrame, path: str) -> None:
    """Full recompute of a derived table kept as files."""
    df.write.mode("overwrite").parquet(path)


def overwrite(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


def append(df: DataFrame, table: str) -> None:
    df.write.mode("append").saveAsTable(table)


def publish_snapshot(df: DataFrame, table: str, version: int) -> None:
    """Write a new version next to the old one, then point the view ``table`` at it.

    The new snapshot may be computed from the old one, and readers see either whole.
    """
    stored = f"{table}__v{version}"
    df.write.mode("overwrite").saveAsTable(stored)
    spark = df.sparkSession
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {stored}")


def describe_table(
    spark: SparkSession, table: str, comment: str, properties: dict[str, str] | None = None
) -> None:
    """Set the comment and properties such as ``quality`` of a table."""

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    spark.sql(f"COMMENT ON TABLE {table} IS {quoted(comment)}")
    if properties:
        pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")
