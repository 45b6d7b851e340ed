"""The pipeline as a whole, stage by stage, on a small folder with awkward rows and names."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lakeward.llm import quality
from tests.llm import brute

DRAW = random.Random(23)
WORDS = ["".join(DRAW.choices("abcdefghij", k=DRAW.randint(2, 7))) for _ in range(400)]
SCHEMA = "doc_id long, text string, lang string, `a.b` string, `c``d` int, _score double, _row int, n_chars long"


def prose(n):
    return " ".join(DRAW.choices(WORDS, k=n))


def junk(n):
    return " ".join(w + "###" for w in DRAW.choices(WORDS, k=n))


@pytest.fixture(scope="module")
def texts():
    good = [prose(60) for _ in range(90)]
    near = good[0].split()
    near[10] = "changed"
    shared = prose(60)
    good += [" ".join(near), good[1], good[1], f"{prose(40)} {shared}", f"{shared} {prose(30)}", shared]
    good += ["password = hunter2hunter2 " + prose(30), prose(3000), None, "", "é one"]
    return [t for pair in zip(good, [junk(40) for _ in good], strict=True) for t in pair]


@pytest.fixture(scope="module")
def folder(spark, texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("folder"))
    rows = [(i, t, "en", "x", 1, 0.5, 7, None if t is None else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1 - i % 2) for i, t in enumerate(texts) if t]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    return path


def test_every_stage_equals_its_plain_version(spark, folder, texts):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = dict(enumerate(texts))
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, folder).cache()
        if name == "best_fit_packing":
            break
        assert found.columns == docs.columns
        rows = {r["doc_id"]: r.asDict() for r in found.collect()}
        assert len(rows) == found.count()
        for r in rows.values():
            assert (r["a.b"], r["c`d"], r["_score"], r["_row"]) == ("x", 1, 0.5, 7)
            assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))
        if name == "quality_classifier":
            scored = quality.classify(docs.drop("_score"), spark.read.parquet(f"{folder}/labels.parquet"))
            want = {r["doc_id"] for r in scored.where(F.col("_score") >= 0.3).collect()}
            assert set(rows) == want and sum(i % 2 for i in want) < 0.1 * len(want) and len(want) > 90
            assert all(rows[i]["text"] == texts[i] for i in rows)
        elif name == "minhash_near_dedup":
            groups, _ = brute.near_groups([(i, t) for i, t in kept.items() if brute.words(t)], 5)
            assert set(rows) == {i for i in kept if groups.get(i, i) == i}
        elif name == "substring_dedup":
            cut = brute.kept_words(sorted(kept.items()))
            for i, (n, words) in cut.items():
                gone = n and not words
                assert (i in rows) != bool(gone)
                if not gone:
                    assert rows[i]["text"] == (kept[i] if len(words) == n else " ".join(words))
        elif name == "secret_scan":
            assert set(rows) == set(kept)
            changed = {i for i in rows if rows[i]["text"] != kept[i]}
            assert changed == {i for i, t in kept.items() if brute.base_spans(t)} and changed
            assert all("hunter2" not in (r["text"] or "") for r in rows.values())
        kept = {i: r["text"] for i, r in rows.items()}
        docs = found
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {(r["doc_id"], r["piece"]): r for r in found.collect()}
    count = 0
    for i, text in kept.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            r, part = pieces[i, k // 2048], ids[k : k + 2048]
            assert (r["start"], r["length"], r["ids_crc32"]) == (k, len(part), brute.crc(part))
            count += 1
    assert count == len(pieces)
    ends = {}
    for r in sorted(pieces.values(), key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    total = sum(r["length"] for r in pieces.values())
    assert max(ends.values()) <= 2048 and len(ends) <= np.ceil(total / 2048) + 1


def test_run_of_the_whole_and_of_an_empty_table(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 90
    none = str(tmp_path / "none")
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{none}/{name}.parquet")
    assert corpus_pipeline.run(spark, none).count() == 0
