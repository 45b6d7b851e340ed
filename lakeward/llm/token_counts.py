"""Token counts through a cache that is keyed by content and tokenizer digests."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.gather import LONGEST
from lakeward.llm.pieces import PieceCache, cut
from lakeward.llm.scratch import prepare, stored
from lakeward.llm.text import blocks
from lakeward.sources.tables import optional_path

MAX_WORDS = 200_000
MAX_KEPT = 120_000
_MARK = b"\xff\xff\xff\xff"
BEYOND_LATIN = "\u0250"
# Control characters that are not white space, and first bytes of characters from U+0240 on.
_BEYOND = bytes([*range(0x09), *range(0x0E, 0x20), 0x7F, *range(0xC9, 0x100)])
CACHE_SCHEMA = "digest binary, version string, n_tokens long"


@lru_cache(maxsize=4)
def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file: another file never reads this one's counts."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _splitters(spec: dict):
    """Splitters of printable ASCII and of Latin text, for vocabularies that lower-case and drop
    white space; (None, None) for files of another make.

    NFC leaves every character below U+0250 alone, and the file's own pattern means the same
    there in Python as long as white space is what Unicode says it is.
    """
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if [x["type"] for x in steps] != ["NFC", "Replace", "Lowercase"]:
        return None, None
    if [x["type"] for x in parts] != ["Split", "ByteLevel"]:
        return None, None
    split, level = parts
    if (split["behavior"], split["invert"], steps[1]["content"]) != ("Removed", True, " "):
        return None, None
    if level["add_prefix_space"] or level["use_regex"]:
        return None, None
    pattern = split["pattern"]["Regex"]
    simple = pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9")
    latin = regex.compile("\n|" + pattern.replace(r"\s", r"\p{White_Space}"))
    return re.compile("\n|" + simple).findall, latin.findall


class _Packed(dict):
    """Packed ids by word, made when first asked for, in two generations of ``MAX_KEPT`` words; a
    word of over ``LONGEST`` characters is not kept.
    """

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.make(word)
        if len(word) <= LONGEST:
            self[word] = ids
        return ids

    def shorten(self) -> None:
        if len(self) > MAX_KEPT:
            self.old = dict(self)
            self.clear()


class FileEncoder:
    """Pieces to token ids by the library's own normaliser, splitter and merges."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join(["[\x00-\x08\x0e-\x1f\x7f]", *map(re.escape, self.special)]))
        self.ascii, self.latin = _splitters(json.loads(self.tokenizer.to_str()))
        # Bytes as the vocabulary spells them: visible ones as they are, others from U+0100 on.
        visible = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173]
        hidden = [b for b in range(256) if b not in set(visible)]
        self.letters = {b: 256 + i for i, b in enumerate(hidden)}
        self.known: dict[str, bytes] = {}
        self.forget()

    def __call__(self, piece: str) -> list[int]:
        if any(token in piece for token in self.special):
            return self.tokenizer.encode(piece, add_special_tokens=False).ids
        if self.tokenizer.normalizer is not None:
            piece = self.tokenizer.normalizer.normalize_str(piece)
        tokens = self.tokenizer.model.tokenize
        words = self.tokenizer.pre_tokenizer.pre_tokenize_str(piece)
        return [token.id for word, _ in words for token in tokens(word)]

    def packed(self, pieces: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of every piece, the same as one by one.

        Where the vocabulary allows it, pieces of Latin text are split together, and merges are
        asked for once per distinct word.
        """
        out: list[bytes | None] = [None] * len(pieces)
        if self.latin:
            plain = [i for i, p in enumerate(pieces) if p.isascii()]
            self._together(pieces, plain, self.ascii, out)
            wide = [i for i, p in enumerate(pieces) if not p.isascii() and max(p) < BEYOND_LATIN]
            self._together(pieces, wide, self.latin, out)
        for i, done in enumerate(out):
            if done is None:
                out[i] = np.array(self(pieces[i]), "<u4").tobytes()
        return out

    def forget(self) -> None:
        self.known.clear()
        self.tokens, self.chunks = _Packed(self._merged), _Packed(self._split)

    def _merged(self, token: str) -> bytes:
        # Printable ASCII spells itself.
        spelled = token
        if not token.isascii():
            spelled = token.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.tokenizer.model.tokenize(spelled)]
        return pack(f"<{len(ids)}I", *ids)

    def _split(self, chunk: str) -> bytes:
        split = self.ascii if chunk.isascii() else self.latin
        return b"".join(map(self.tokens.__getitem__, split(chunk)))

    def whole(self, texts: Sequence[bytes], limit: int) -> list[bytes | None]:
        """Packed ids of whole UTF-8 texts; None for those that are left to :meth:`packed`.

        Where the vocabulary allows it a text of at most ``limit`` bytes, of Latin letters, without
        control characters and special strings, falls apart at white space, which no token
        crosses; ids are made once per distinct chunk, merges asked for once per distinct token.
        """
        out: list[bytes | None] = [None] * len(texts)
        if not self.latin:
            return out
        special = [token.encode() for token in self.special]
        for i, text in enumerate(texts):
            if len(text) > limit or len(text.translate(None, _BEYOND)) < len(text):
                continue
            if any(token in text for token in special):
                continue
            self.tokens.shorten()
            self.chunks.shorten()
            chunks = text.decode().lower().split()
            out[i] = b"".join(map(self.chunks.__getitem__, chunks))
        return out

    def _together(self, pieces: list[str], which: list[int], split, out: list) -> None:
        if self.odd.search("\n".join([pieces[i] for i in which])):
            which = [i for i in which if not self.odd.search(pieces[i])]
        if not which:
            return
        # A line break ends each piece; inside a piece any white space will do.
        text = "".join([pieces[i].replace("\n", " ") + "\n" for i in which]).lower()
        words = split(text)
        if len(self.known) > MAX_WORDS:
            self.known.clear()
        self.known["\n"] = _MARK
        tokens, letters = self.tokenizer.model.tokenize, self.letters
        for word in set(words).difference(self.known):
            spelled = word.encode().decode("latin-1").translate(letters)
            self.known[word] = np.array([t.id for t in tokens(spelled)], "<u4").tobytes()
        ids = b"".join(map(self.known.__getitem__, words))
        ends = np.flatnonzero(np.frombuffer(ids, "<u4") == 0xFFFFFFFF).tolist()
        start = 0
        for i, end in zip(which, ends, strict=True):
            out[i] = ids[4 * start : 4 * end]
            start = end + 1


@lru_cache(maxsize=2)
def _count_cache(path: str) -> PieceCache:
    encoder = FileEncoder(path)
    return PieceCache(lambda pieces: [len(encoder(p)) for p in pieces])


def count_tokens(texts: list[str], path: str) -> list[int]:
    """Token counts of whole texts; a worker keeps the counts of pieces it has met."""
    cache, out = _count_cache(path), []
    for start, end in blocks(texts):
        out += map(sum, cache.values([cut(t) for t in texts[start:end]]))
    return out


def token_counts(docs: DataFrame, path: str, cache: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per row of ``docs``; counts live on in the table ``cache``.

    The content is normalised only in that null counts as empty: any other change would
    change counts.  One row of each distinct content without a stored count is encoded, whole,
    and its count appended; copies, also huge groups, cost one digest each.  A second run over
    the same texts encodes nothing.  ``cache`` is a folder that all executors share; parts that
    two runs appended at the same time may repeat a digest and then agree.  Rows that repeat a
    doc_id get a result row each, null ids included; equal rows may be encoded once each.
    """
    spark = prepare(docs.sparkSession)
    version = tokenizer_version(path)
    slim = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digest = F.unhex(F.sha2("text", 256))
    keyed = slim.select("doc_id", digest.alias("digest"), F.octet_length("text").alias("n_bytes"))

    def known() -> DataFrame:
        table = optional_path(spark, cache)
        if table is None:
            table = spark.createDataFrame([], CACHE_SCHEMA)
        own = table.where(F.col("version") == version)
        return own.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    # Of each missing content the row with the smallest id; a null id sorts first, as its own.
    chosen = (
        keyed.groupBy("digest")
        .agg(F.min(F.struct("doc_id")).alias("pick"))
        .join(known(), "digest", "left_anti")
        .select("digest", F.col("pick.doc_id").alias("doc_id"))
    )
    rows = slim.withColumn("digest", digest).alias("d").join(
        chosen.alias("c"),
        (F.col("d.digest") == F.col("c.digest")) & F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")),
        "left_semi",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = count_tokens(batch.column("text").fill_null("").to_pylist(), path)
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array([version] * len(counts)), pa.array(counts, "int64")],
                ["digest", "version", "n_tokens"],
            )

    missed = rows.select("digest", "text").mapInArrow(run, CACHE_SCHEMA)
    missed.write.mode("append").parquet(cache)
    # A stored side lets adaptive execution split the rows of a content with very many copies.
    return keyed.join(stored(known(), "counts"), "digest").select(
        "doc_id", F.col("n_bytes").cast("long").alias("n_bytes"), "n_tokens"
    )
