"""Text documents, overlapping chunks, vectors and exact cosine top-k."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions import fill_template
from lakeward.operators.dedup import top_n_per_group

# Chunking, retrieval and vector sizes; labels of the policy document.
CHUNK_SIZE = 400
CHUNK_OVERLAP = 80
TOP_K = 4
DIMENSIONS = 384
POLICY_LABELS = [
    ("Policy Number", "policy_number"),
    ("State", "policy_state"),
    ("CSL Coverage", "policy_csl"),
    ("Deductible", "policy_deductable"),
    ("Annual Premium", "policy_annual_premium"),
    ("Umbrella Limit", "umbrella_limit"),
    ("Vehicle ID", "car_id"),
    ("Customer ID", "customer_id"),
]

SCORE_DIGITS = 9
MAX_QUESTION_BYTES = 64 * 1024 * 1024
# Scores held at a time by a task.
TILE = 1 << 21
# ASCII letters in lower case and digits; all other bytes are 0.
_LETTERS = np.zeros(256, np.uint8)
for _letter in b"abcdefghijklmnopqrstuvwxyz0123456789":
    _LETTERS[[_letter, ord(chr(_letter).upper())]] = _letter
# Words whose bucket a task remembers.
MOST_KNOWN = 1_000_000


def labelled_text(labels: list[tuple[str, str]] = POLICY_LABELS) -> Column:
    """A row as lines of ``label: value``, framed by line breaks."""
    body = "".join(f"{label}: {{{column}}}\n" for label, column in labels)
    return fill_template("\n" + body, {column: F.col(column) for _, column in labels})


def chunk_texts(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Array of overlapping pieces that together cover the whole text.

    One pass of a pattern goes through the text by strides of ``size - overlap`` characters and
    looks ahead for the whole piece at each, so the cost is linear in the length of the text.  A
    last stride that the piece before it already covers makes no piece of its own; an empty text
    has none.
    """
    if not 0 < overlap <= size - overlap:
        raise ValueError("overlap must be positive and at most half of size")
    stride = size - overlap
    pieces = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{size}}})).{{1,{stride}}}"), F.lit(1))
    whole = F.greatest(F.lit(1), F.ceil((F.length(text) - overlap) / F.lit(float(stride))))
    return F.slice(pieces, 1, whole.cast("int"))


def chunk_documents(
    docs: DataFrame,
    key: str,
    text: str,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """(chunk_id, key, text): one row per piece, chunk_id = key and position.

    Narrow: no shuffle, documents are exploded where they are read.
    """
    pieces = docs.select(
        F.col(key), F.posexplode(chunk_texts(F.col(text), size, overlap)).alias("_i", "_piece")
    )
    return pieces.select(
        F.concat_ws("_", F.col(key).cast("string"), F.col("_i").cast("string")).alias("chunk_id"),
        F.col(key),
        F.col("_piece").alias("text"),
    )


def _packed(column: str) -> str:
    """The column beside one of counts or vectors of words: the buckets of a text's words."""
    return f"_{column}"


def _buckets(texts: pa.Array, dims: int, known: dict[bytes, int]) -> pa.Array:
    """Per text the buckets of its words, two bytes each; ``known`` keeps what has been hashed.

    Works on the bytes of all texts at once: what is no word is dropped, equal words are found
    by Arrow, and a digest is taken of each different word only.
    """
    texts = pc.fill_null(texts, "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset :][: len(texts) + 1]
    raw = texts.buffers()[2]
    letters = _LETTERS[np.frombuffer(raw or b"", np.uint8)[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    inside = letters > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(letters)]
    begins[firsts] = inside[firsts]
    place = np.flatnonzero(begins)
    ends = np.append(np.flatnonzero(begins[inside]), np.count_nonzero(inside)).astype(np.int32)
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(letters[inside])]
    words = pa.Array.from_buffers(pa.binary(), len(place), buffers).dictionary_encode()
    if len(known) > MOST_KNOWN:
        known.clear()
    found = np.zeros(len(words.dictionary), "<u2")
    for at, word in enumerate(words.dictionary.to_pylist()):
        if (bucket := known.get(word)) is None:
            digest = hashlib.md5(word, usedforsecurity=False).digest()
            bucket = known[word] = int.from_bytes(digest[:4], "big") % dims
        found[at] = bucket
    # Words that begin before the end of a text, for all texts.
    counts = np.searchsorted(place, offsets).astype(np.int32) * 2
    data = found[words.indices.to_numpy()]
    return pa.Array.from_buffers(
        pa.binary(), len(texts), [None, pa.py_buffer(counts), pa.py_buffer(data)]
    )


def _counted(packed: pa.Array, dims: int) -> np.ndarray:
    """A row per text of :func:`_buckets`: how many of its words fall into each bucket."""
    rows = len(packed)
    offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset :][: rows + 1]
    data = np.frombuffer(packed.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    owner = np.repeat(np.arange(rows), np.diff(offsets) // 2)
    places = owner * dims + data.view("<u2")
    return np.bincount(places, minlength=dims * rows).astype(float).reshape(rows, dims)


def term_counts(
    df: DataFrame, text: str = "text", out: str = "counts", dims: int = DIMENSIONS
) -> DataFrame:
    """Add ``out``: how often the words of a text fall into each of ``dims`` buckets.

    Words are runs of ASCII letters and digits, in lower case; a word's bucket are the first 32
    bits of its MD5 digest, modulo ``dims``, which any engine can repeat.  Null has no words.
    Beside it comes ``_out``, the buckets of the words themselves: some bytes a word, from which
    ``out`` is made only where it is asked for.
    """
    if not 0 < dims <= 1 << 16:
        raise ValueError("dims must be positive and fit two bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            if batch.num_rows:
                row = batch.column("_row")
                packed = _buckets(pc.struct_field(row, text), dims, known)
                yield pa.RecordBatch.from_arrays([row, packed], ["_row", "_packed"])

    names = [F.col(f"`{c}`") for c in df.columns]
    boxed = df.select(F.struct(*names).alias("_row"))
    schema = T.StructType([boxed.schema["_row"]]).add("_packed", T.BinaryType())
    found = boxed.mapInArrow(run, schema).select("_row.*", F.col("_packed").alias(_packed(out)))

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def dense(packed: pa.Array) -> pa.Array:
        ends = pa.array(np.arange(len(packed) + 1, dtype=np.int32) * dims)
        return pa.ListArray.from_arrays(ends, pa.array(_counted(packed, dims).ravel()))

    return found.withColumn(out, dense(_packed(out)))


def inverse_frequencies(
    counted: DataFrame, counts: str = "counts", dims: int = DIMENSIONS
) -> Column:
    """One list of ``dims`` weights, ln((n + 1) / (d + 1)) for a bucket that d of n rows use.

    ``counted`` comes from :func:`term_counts`.  A scalar of the query that uses it: nothing runs
    before that does.  A task sends a row for each batch of texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, used = 0, np.zeros(dims, np.int64)
        for batch in batches:
            rows += batch.num_rows
            if batch.num_rows:
                used += (_counted(batch.column(0), dims) > 0).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"rows": [rows], "used": [used.tolist()]})

    tasks = counted.select(_packed(counts)).mapInArrow(run, "rows long, used array<long>")
    sums = tasks.select("rows", F.posexplode("used").alias("bucket", "d"))
    sums = sums.groupBy("bucket").agg(F.sum("rows").alias("n"), F.sum("d").alias("d"))
    every = counted.sparkSession.range(dims).select(F.col("id").cast("int").alias("bucket"))
    n, d = F.coalesce("n", F.lit(0)), F.coalesce("d", F.lit(0))
    weight = F.ln((n + 1) / (d + 1))
    listed = every.join(sums, "bucket", "left").select(F.struct("bucket", weight.alias("weight")).alias("w"))
    return listed.agg(F.array_sort(F.collect_list("w"))["weight"]).scalar()


def weighted_vectors(
    df: DataFrame, weights: Column, counts: str = "counts", out: str = "embedding"
) -> DataFrame:
    """Counts times weights, as vectors for :func:`top_k`.

    Any function that adds a column of numbers can take the place of these vectors.  With counts
    of :func:`term_counts` the buckets come along as ``_out`` and the weights as ``_out_weights``,
    so that :func:`top_k` need not move the vectors.
    """
    weighed = f"{_packed(out)}_weights"
    vector = F.zip_with(counts, weighed, lambda n, w: n * w)
    found = df.withColumn(weighed, weights).withColumn(out, vector)
    if _packed(counts) not in df.columns:
        return found.drop(counts, weighed)
    return found.withColumnRenamed(_packed(counts), _packed(out)).drop(counts)


def text_vectors(
    questions: DataFrame, question: str, corpus: DataFrame, text: str, dims: int = DIMENSIONS
) -> tuple[DataFrame, DataFrame]:
    """Both tables with ``embedding``: counts of words weighted by how rare they are in the corpus."""
    weights = inverse_frequencies(term_counts(corpus.select(text), text, dims=dims), dims=dims)
    asked = weighted_vectors(term_counts(questions, question, dims=dims), weights)
    return asked, weighted_vectors(term_counts(corpus, text, dims=dims), weights)


def top_k(
    questions: DataFrame,
    corpus: DataFrame,
    k: int = TOP_K,
    question_id: str = "question_id",
    item_id: str = "chunk_id",
    vector: str = "embedding",
    carry: Sequence[str] = (),
    max_question_bytes: int = MAX_QUESTION_BYTES,
    shards: int | None = None,
) -> DataFrame:
    """(question_id, item_id, score, rank, carry...): the ``k`` most similar items, exactly.

    Cosine similarity to nine digits, ties broken by item id.  Questions are dealt to blocks of
    about ``max_question_bytes`` and the corpus to ``shards`` (default: the session's shuffle
    partitions); every pair of a block and a shard is a cell, and a task multiplies one cell at
    a time, in tiles.  So the memory of a task is bounded for any number of questions; the number
    of blocks is found while the query runs, from the questions alone.  Cells keep ``k`` items
    per question, and their lists are merged in two steps.  Zero vectors score 0.  Columns named
    in ``carry`` come along, which saves joining the result back to the corpus.

    Where both tables come from :func:`weighted_vectors` with the buckets of their words, these
    go to the cells instead of the vectors, which are made there, tile by tile; the weights go
    with the questions.
    """
    spark = corpus.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    weighed = f"{_packed(vector)}_weights"
    sparse = _packed(vector) in corpus.columns and {weighed, _packed(vector)} <= {*questions.columns}
    asked = questions.select(
        F.col(question_id).alias("question_id"),
        F.col(vector).cast("array<double>").alias("_v"),
        *[F.col(weighed).alias("_w")] * sparse,
    )
    size = F.count("*") * F.max(F.size("_v")) * 8
    blocks = asked.agg(F.greatest(F.lit(1), F.ceil(size / max_question_bytes)).cast("int")).scalar()
    blocks = F.coalesce(blocks, F.lit(1))
    asked = asked.select(
        "*",
        F.pmod(F.xxhash64("question_id"), blocks).cast("int").alias("_block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_shard"),
    )
    items = corpus.select(
        F.col(item_id).alias("item_id"),
        F.col(_packed(vector) if sparse else vector).alias("_v"),
        *carry,
        F.pmod(F.xxhash64(item_id), F.lit(shards)).cast("int").alias("_shard"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_block"),
    )
    schema = ", ".join(
        [
            f"question_id {asked.schema['question_id'].dataType.simpleString()}",
            f"item_id {items.schema['item_id'].dataType.simpleString()}",
            "score double, _shard int",
            *[f"`{c}` {corpus.schema[c].dataType.simpleString()}" for c in carry],
        ]
    )
    cells = asked.groupBy("_block", "_shard").cogroup(items.groupBy("_block", "_shard"))
    lists = cells.applyInArrow(_best_in_cell(k, SCORE_DIGITS, list(carry)), schema)
    order = [F.desc("score"), F.asc("item_id")]
    # Lists of neighbouring shards first: no task sees the lists of all shards at once.
    near = F.floor(F.col("_shard") / max(1, math.isqrt(shards)))
    merged = top_n_per_group(lists, ["question_id", near], order, k).drop("_rank")
    best = top_n_per_group(merged, "question_id", order, k)
    return best.select(
        F.col("question_id").alias(question_id),
        F.col("item_id").alias(item_id),
        "score",
        F.col("_rank").alias("rank"),
        *carry,
    )


def _unit_rows(column: pa.ChunkedArray, weights: np.ndarray | None = None) -> np.ndarray:
    """Vectors of length 1, or 0; with ``weights`` from the buckets of words."""
    column = column.combine_chunks()
    if weights is not None:
        return _unit(_counted(column, len(weights)) * weights)
    lengths = pc.list_value_length(column)
    width = pc.max(lengths).as_py() or 0
    if pc.min(lengths).as_py() != width or column.null_count:
        raise ValueError("vectors must be present and of equal length")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return _unit(flat.reshape(len(column), width))


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _best_in_cell(k: int, digits: int, carry: list[str]):
    """Group function: the best ``k`` items per question of one cell, tile by tile."""

    def best(asked: pa.Table, items: pa.Table) -> pa.Table:
        held = items.drop_columns(["_v", "_block"])
        if not asked.num_rows or not items.num_rows:
            none = asked.slice(0, 0).select(["question_id"])
            held = held.slice(0, 0).append_column("score", pa.array([], pa.float64()))
            for name in ["item_id", "score", "_shard", *carry]:
                none = none.append_column(name, held.column(name))
            return none
        rows, weights = _unit_rows(asked.column("_v")), None
        if "_w" in asked.column_names:
            weights = np.array(asked.column("_w")[0].as_py())
        at, scored, owner = (np.zeros(0, t) for t in (np.int64, np.float64, np.int64))
        # Ids in order tell ties apart by place.
        items = items.sort_by("item_id")
        held = items.drop_columns(["_v", "_block"])
        step = max(1, TILE // len(rows))
        for start in range(0, items.num_rows, step):
            tile = _unit_rows(items.column("_v").slice(start, step), weights)
            # + 0.0 turns a rounded -0.0 into 0.0, so equal scores tie as equal.
            scores = np.round(rows @ tile.T, digits) + 0.0
            take = min(k, len(tile))
            # Keep everything that ties with the k-th score: the id decides later.
            limit = -np.partition(-scores, take - 1, axis=1)[:, take - 1 : take]
            q, i = np.nonzero(scores >= limit)
            at, owner = np.append(at, i + start), np.append(owner, q)
            scored = np.append(scored, scores[q, i])
            turn = np.lexsort((at, -scored, owner))
            at, scored, owner = at[turn], scored[turn], owner[turn]
            place = np.arange(len(owner)) - np.searchsorted(owner, owner, side="left")
            at, scored, owner = at[place < k], scored[place < k], owner[place < k]
        found = held.take(pa.array(at)).append_column("score", pa.array(scored))
        found = found.append_column("question_id", asked.column("question_id").take(pa.array(owner)))
        return found.select(["question_id", "item_id", "score", "_shard", *carry])

    return best


def retrieval_context(ranked: DataFrame, owner: str) -> DataFrame:
    """Per question: context in rank order, distinct sources, mean score as confidence.

    ``ranked`` is the result of :func:`top_k` carrying ``owner`` and ``text``.  A group
    holds at most ``k`` rows, so collecting it is bounded.
    """
    entry = fill_template(
        "\nPolicy {owner}:\n{text}\n", {"owner": F.col(owner), "text": F.col("text")}
    )
    grouped = ranked.groupBy("question_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", entry.alias("entry")))).alias("_entries"),
        F.array_sort(F.collect_set(F.col(owner).cast("string"))).alias("source_policies"),
        F.avg("score").alias("confidence_score"),
    )
    return grouped.select(
        "question_id",
        F.array_join(F.col("_entries.entry"), "").alias("context"),
        "source_policies",
        "confidence_score",
    )


def latest(df: DataFrame, time: str, n: int, *ties: str) -> DataFrame:
    """The ``n`` most recent rows, without a full sort."""
    return df.orderBy(F.desc(time), *ties).limit(n)
