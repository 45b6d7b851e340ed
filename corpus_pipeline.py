"""From raw documents to packed sequences: five stages, each stored and read by the next."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm import minmax_dedup, packing, quality, secret_scan, substring
from lakeward.llm.scratch import stored
from lakeward.sources.tables import shared_folder


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _boxed(docs: DataFrame) -> tuple[DataFrame, str]:
    """(doc_id, text, box), and the name of the box, which no column has: all columns, whatever
    their names, travel inside it.
    """
    box = "_row"
    while box in docs.columns:
        box += "_"
    row = F.struct(*[F.col(_quoted(c)) for c in docs.columns])
    return docs.select("doc_id", "text", row.alias(box)), box


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of ``sf_dir``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    boxed, box = _boxed(docs)
    scored = quality.classify(boxed, labels)
    return scored.where(F.col("_score") >= quality.THRESHOLD).select(f"{box}.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity from 0.8.

    The smallest doc_id of a group stays.  Of rows that repeat a doc_id with the same text one
    stays, of rows without doc_id those that repeat no other text: the decision holds for a
    doc_id and a text together.
    """
    settings = minmax_dedup.Settings(shingle=5)
    found = minmax_dedup.near_duplicates(docs, settings, with_digest=True)
    kept = stored(
        found.where("kept")
        .select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha256"))
        .distinct(),
        "kept",
    )
    boxed, box = _boxed(docs)
    rows = boxed.withColumn("_sha256", F.sha2("text", 256)).join(
        kept,
        F.col("doc_id").eqNullSafe(F.col("_kept_id"))
        & F.col("_sha256").eqNullSafe(F.col("_kept_sha256")),
        "left_semi",
    )
    return rows.dropDuplicates(["doc_id", "_sha256"]).select(f"{box}.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without words that repeat an earlier document's passage of 50 words.

    A document that loses nothing keeps its text as it is; one that loses all its words goes.
    """
    boxed, box = _boxed(docs)
    cut = substring.remove_repeats(boxed, (box,))
    text = F.when(F.col("_removed") > 0, F.col("_kept")).otherwise(F.col(f"{box}.text"))
    rows = cut.where((F.col("_removed") == 0) | (F.col("_removed") < F.col("_words")))
    return rows.select(*_with_text(docs, box, text, F.col("_removed") > 0))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by a mark; all documents stay."""
    boxed, box = _boxed(docs)
    found = secret_scan.find_secrets(boxed, (box,))
    text = secret_scan.redacted(F.coalesce(f"{box}.text", F.lit("")), F.col("_spans"))
    changed = F.size("_spans") > 0
    text = F.when(changed, text).otherwise(F.col(f"{box}.text"))
    return found.select(*_with_text(docs, box, text, changed))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of at most 2048 tokens."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def _with_text(docs: DataFrame, box: str, text, changed) -> list:
    """The columns of ``docs`` with a new text and the length that goes with it."""
    new = {"text": text}
    if "n_chars" in docs.columns:
        length = F.length(text).cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(changed, length).otherwise(F.col(f"{box}.n_chars"))
    return [new.get(c, F.col(f"{box}.{_quoted(c)}")).alias(c) for c in docs.columns]


STAGES = [
    ("quality_classifier", quality_filter),
    ("minhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_scan", secret_redaction),
    ("best_fit_packing", best_fit_packing),
]

# A trained classifier and a tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
