"""The registered queries: each operator over its whole table, with its digest columns."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm import (
    block_ann,
    bpe_replay,
    exact_topk,
    license_scan,
    minmax_dedup,
    packing,
    periodic_runs,
    quality,
    secret_scan,
    sentence_pieces,
    substring,
    token_counts,
    whitening,
)
from lakeward.sources.tables import shared_folder

MAX_TOKENS = 1024


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.classify(docs, _table(spark, sf_dir, "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.exact_top_k(_table(spark, sf_dir, "embeddings"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(_table(spark, sf_dir, "documents"))
    counts = [
        secret_scan.number_of(F.col("_base"), k).alias(f"n_{name}")
        for k, name in enumerate(secret_scan.KINDS[:3])
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secret_scan.listed(F.col("_base")), 256).alias("base_sha256"),
        secret_scan.listed(F.col("_spans")).alias("spans"),
    )


def op5_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        F.col("_words").alias("n_words"),
        F.col("_removed").alias("n_removed"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        f"{shared_folder(spark)}/token-counts-{uuid.uuid4().hex}",
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op9_block_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_ann.nearest(_table(spark, sf_dir, "embeddings"))


def op10_bpe_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe_replay.encode(
        _table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN
    )
    return bpe_replay.decode(encoded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = _table(spark, sf_dir, "documents")
    return sentence_pieces.encode(docs, path, with_decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def _tiled(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in every tenth document, by digest, the words repeat from a place on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"))

    def tiled(w):
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        places = F.sequence(F.lit(0).cast("long"), n - 1)
        moved = F.transform(places, lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(moved, " ")).otherwise("")

    text = F.when(h % 10 == 0, F.transform(F.array(words), tiled)[0]).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_tiled(_table(spark, sf_dir, "documents")))
    # The longest run: of several the first, then the one of the smallest period.
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(
            r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))
        )
    )
    start, length, period = -best["s"], best["length"], -best["p"]
    line = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor((1000 * length) / period).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_quality_classifier,
        op3_exact_topk,
        op4_secret_scan,
        op5_minmax_near_dedup,
        op6_substring_dedup,
        op7_token_counts,
        op8_best_fit_packing,
        op9_block_ann,
        op10_bpe_replay,
        op11_sentence_pieces,
        op12_whitening,
        op13_periodic_runs,
    )
}
