import hashlib
import json
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeward.operators import generate, retrieval
from lakeward.plans import reports


def pieces(text, size=400, overlap=80):
    """What chunking must yield, by plain slicing."""
    found, start = [], 0
    while start < len(text):
        found.append(text[start : start + size])
        if start + size >= len(text):
            break
        start += size - overlap
    return found


@pytest.mark.parametrize("length", [0, 1, 80, 319, 320, 321, 400, 401, 480, 720, 721, 2000])
def test_chunk_lengths(spark, length):
    text = "".join(chr(97 + i % 26) for i in range(length))
    df = spark.createDataFrame([(1, text)], "id int, text string")
    rows = retrieval.chunk_documents(df, "id", "text").collect()
    assert [r["text"] for r in rows] == pieces(text)
    assert [r["chunk_id"] for r in rows] == [f"1_{i}" for i in range(len(rows))]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab\n\r é😀", max_size=60), min_size=1, max_size=20))
def test_chunks_of_any_text(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found: dict[int, list[str]] = {}
    for row in retrieval.chunk_documents(df, "id", "text", size=10, overlap=3).collect():
        found.setdefault(row["id"], []).append(row["text"])
    assert all(found.get(i, []) == pieces(t, 10, 3) for i, t in enumerate(texts))


def brute_force(questions, corpus, k):
    result = []
    for qid, q in questions:
        def score(v, q=q):
            norm = np.linalg.norm(v) * np.linalg.norm(q)
            return round(float(np.dot(v, q) / norm), 9) + 0.0 if norm else 0.0

        ranked = sorted(((-score(np.array(v)), i) for i, v in corpus))[:k]
        result += [(qid, i, n + 1) for n, (_, i) in enumerate(ranked)]
    return sorted(result)


def vectors(spark, rows, name):
    return spark.createDataFrame(rows, f"{name} long, embedding array<float>")


@pytest.mark.parametrize("limit", [1, 64 * 1024 * 1024])
def test_topk_equals_brute_force_in_one_or_many_passes(spark, limit):
    rng = np.random.default_rng(7)
    corpus = [(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(400)]
    corpus += [(1000, [0.0] * 6)]
    asked = [(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(5)]
    found = retrieval.top_k(
        vectors(spark, asked, "question_id"),
        vectors(spark, corpus, "chunk_id").repartition(7),
        4,
        max_question_bytes=limit,
    )
    rows = sorted((r["question_id"], r["chunk_id"], r["rank"]) for r in found.collect())
    assert rows == brute_force(asked, corpus, 4)


def test_topk_edges(spark):
    corpus = vectors(spark, [(2, [1.0, 0.0]), (1, [1.0, 0.0]), (3, [0.0, 0.0])], "chunk_id")
    asked = vectors(spark, [(0, [2.0, 0.0])], "question_id")
    rows = sorted(retrieval.top_k(asked, corpus, 10).collect(), key=lambda r: r["rank"])
    assert [(r["chunk_id"], r["score"]) for r in rows] == [(1, 1.0), (2, 1.0), (3, 0.0)]
    assert retrieval.top_k(asked.where("false"), corpus, 4).count() == 0


def test_planning_a_topk_runs_nothing(spark):
    corpus = vectors(spark, [(i, [1.0, float(i)]) for i in range(5)], "chunk_id")
    failing = corpus.where(F.raise_error(F.lit("ran")).cast("string").isNull())
    asked = failing.withColumnRenamed("chunk_id", "question_id")
    assert retrieval.top_k(asked, failing, 2).columns == ["question_id", "chunk_id", "score", "rank"]


def test_many_questions_go_through_in_blocks(spark):
    rng = np.random.default_rng(1)
    table = rng.integers(-9, 10, (20_000, 4)).astype(float)
    asked = vectors(spark, [(i, v.tolist()) for i, v in enumerate(table)], "question_id")
    corpus = [(i, v.tolist()) for i, v in enumerate(rng.integers(-9, 10, (60, 4)).astype(float))]
    found = retrieval.top_k(
        asked, vectors(spark, corpus, "chunk_id"), 2, max_question_bytes=200_000, shards=3
    )
    rows = sorted((r["question_id"], r["chunk_id"], r["rank"]) for r in found.collect())
    some = [(i, table[i]) for i in range(0, 20_000, 397)]
    assert len(rows) == 40_000
    assert [r for r in rows if r[0] % 397 == 0] == brute_force(some, corpus, 2)


def test_words_weigh_by_how_few_chunks_use_them(spark):
    texts = ["Alpha beta, ALPHA", "beta gamma", None, "é!", "beta"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(2)
    counted = retrieval.term_counts(docs, "text", dims=64)
    bucket = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 64
    rows = {r["id"]: np.array(r["counts"]) for r in counted.collect()}
    want = np.zeros(64)
    want[bucket("alpha")] += 2
    want[bucket("beta")] += 1
    assert (rows[0] == want).all() and rows[2].sum() == rows[3].sum() == 0
    weights = counted.select(retrieval.inverse_frequencies(counted, dims=64)).first()[0]
    assert weights[bucket("beta")] == pytest.approx(np.log(6 / 4))
    assert weights[bucket("alpha")] == pytest.approx(np.log(6 / 2))
    assert weights[bucket("absent word")] == pytest.approx(np.log(6))


def test_text_topk_equals_brute_force(spark):
    docs = spark.createDataFrame(
        [(i, f"policy number {i} covers car {i * 7} umbrella") for i in range(60)], "doc_id int, text string"
    )
    asked = spark.createDataFrame([(1, "which policy covers car 357")], "question_id long, text string")
    chunks = retrieval.chunk_documents(docs, "doc_id", "text")
    asked, chunks = retrieval.text_vectors(asked, "text", chunks, "text")
    found = retrieval.top_k(asked, chunks, 4).collect()
    corpus = [(r["chunk_id"], r["embedding"]) for r in chunks.collect()]
    expected = brute_force([(1, asked.first()["embedding"])], corpus, 4)
    assert sorted((r["question_id"], r["chunk_id"], r["rank"]) for r in found) == expected
    assert min(found, key=lambda r: r["rank"])["chunk_id"] == "51_0"


def test_answers_carry_context_and_sources(spark):
    docs = spark.createDataFrame([("P1", "alpha beta"), ("P2", "gamma delta")], "policy_number string, text string")
    asked = spark.createDataFrame([(1, "alpha beta")], "question_id long, question string")
    chunks = retrieval.chunk_documents(docs, "policy_number", "text")
    rows = reports.answer_questions(
        *retrieval.text_vectors(asked, "question", chunks, "text"), "policy_number",
        "From {context}: {question}?", F.lit("2024-01-01").cast("timestamp"),
        generator=lambda p: p, k=1,
    ).collect()
    assert rows[0]["source_policies"] == ["P1"] and rows[0]["confidence_score"] == pytest.approx(1.0)
    assert rows[0]["answer"] == "From \nPolicy P1:\nalpha beta\n: alpha beta?"
    assert rows[0]["question"] == "alpha beta"


def test_policy_text(spark):
    names = [c for _, c in retrieval.POLICY_LABELS]
    df = spark.createDataFrame([tuple("abcdefg") + (None,)], ", ".join(f"{c} string" for c in names))
    text = df.select(retrieval.labelled_text()).first()[0]
    assert text.startswith("\nPolicy Number: a\nState: b\n") and text.endswith("Customer ID: None\n")


def test_generator_retries_and_reports(spark):
    def fussy(prompt):
        if prompt == "never":
            raise RuntimeError("no answer")
        if prompt == "later":
            fussy.calls = getattr(fussy, "calls", 0) + 1
            if fussy.calls < 3:
                raise RuntimeError("busy")
        return prompt.upper()

    df = spark.createDataFrame([("ok",), ("later",), ("never",)], "prompt string").coalesce(1)
    rows = {r["prompt"]: r for r in generate.with_generated(df, "prompt", "out", fussy).collect()}
    assert tuple(rows["ok"])[1:] == ("OK", "SUCCESS", 1)
    assert tuple(rows["later"])[1:] == ("LATER", "SUCCESS", 3)
    assert tuple(rows["never"])[1:] == ("LLM_FAILED", "FAILED", 3)
    told = generate.with_generated(df, "prompt", "out", fussy, failed_text=None, retries=1)
    assert {r["prompt"]: r["out"] for r in told.collect()}["never"] == "no answer"


def test_issue_ids_are_stable_and_failures_show(spark):
    issues = spark.createDataFrame(
        [("b", "y", 5, "LOW"), ("a", "z", 200, "HIGH"), ("a", "x", 20, "MEDIUM")],
        "table_name string, rule_name string, affected_records long, severity string",
    )

    def refuse(prompt):
        raise ValueError("down")

    ts = F.lit("2024-01-01").cast("timestamp")
    rows = reports.issue_explanations(issues, "{rule_name}", "m", ts, generator=refuse).collect()
    assert sorted((r["issue_id"], r["rule_name"]) for r in rows) == [("1", "x"), ("2", "z"), ("3", "y")]
    assert {(r["generation_status"], r["ai_explanation"]) for r in rows} == {("FAILED", "down")}
    assert len(rows[0]) == 9


@pytest.mark.parametrize(
    ("response", "text"),
    [
        ({"choices": [{"message": {"content": "plain"}}]}, "plain"),
        ({"choices": [{"message": {"content": '[{"type":"text","text":"x"}]'}}]}, '[{"type":"text","text":"x"}]'),
        ({"choices": [{"message": {"content": [{"type": "r", "text": "n"}, {"type": "text", "text": "y"}]}}]}, "y"),
        ({"choices": [{"message": {"content": []}}, {"message": {"content": "second"}}]}, "second"),
        ({"choices": [{"message": {}}]}, ""),
        ({"choices": []}, ""),
        ({}, ""),
        (None, ""),
    ],
)
def test_response_text(spark, response, text):
    raw = json.dumps(response) if response is not None else "not json"
    df = spark.createDataFrame([(raw,)], "r string")
    assert df.select(generate.response_text(F.col("r"))).first()[0] == text


def test_chunks_are_cut_in_one_pass(spark):
    """Each piece once looked at the whole text again: 500,000 letters took minutes."""
    text = "".join(chr(97 + i * i % 26) for i in range(500_000))
    df = spark.createDataFrame([(1, text)], "id int, text string").coalesce(1)
    began = time.monotonic()
    rows = retrieval.chunk_documents(df, "id", "text").collect()
    assert time.monotonic() - began < 30
    assert [r["text"] for r in rows] == pieces(text)


@pytest.mark.parametrize("limit", [1, 64 * 1024 * 1024])
def test_texts_go_to_the_cells_as_buckets_of_words(spark, limit):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["Ab", "b1", "é", "", "C-c", "dd\nEE", "z" * 60, "9"], 7)) for _ in range(90)]
    docs = spark.createDataFrame([(f"d{i:02d}", t) for i, t in enumerate([*texts, None, ""])], "chunk_id string, text string")
    asked = spark.createDataFrame(list(enumerate(texts[::20] + ["nothing here", None])), "question_id int, text string")
    asked, chunks = retrieval.text_vectors(asked, "text", docs.repartition(5), "text", dims=32)
    found = retrieval.top_k(asked, chunks, 3, carry=["text"], max_question_bytes=limit)
    dense = [
        df.select(key, "embedding") for df, key in ((asked, "question_id"), (chunks, "chunk_id"))
    ]
    plain = retrieval.top_k(*dense, 3)
    keep = ["question_id", "chunk_id", "score", "rank"]
    assert sorted(found.select(*keep).collect()) == sorted(plain.select(*keep).collect())
    # The vectors themselves are not what is moved.
    assert "_embedding" in chunks.columns and dict(chunks.dtypes)["_embedding"] == "binary"


def test_words_of_any_text(spark):
    texts = ["", "a", "a a-A", "ab", "-", "xéy", "1b 1B", " a ", None, "\U0001f600q", "a" * 300]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").coalesce(1)
    want = {}
    for i, t in enumerate(texts):
        row = np.zeros(50)
        for w in re.findall("[A-Za-z0-9]+", t or ""):
            row[int(hashlib.md5(w.lower().encode()).hexdigest()[:8], 16) % 50] += 1
        want[i] = row.tolist()
    assert {r["id"]: r["counts"] for r in retrieval.term_counts(df, dims=50).collect()} == want
