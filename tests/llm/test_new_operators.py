"""SentencePiece, whitening and periodic runs: operators and their queries on awkward rows."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from lakeward.llm import periodic_runs, queries, sentence_pieces, whitening
from lakeward.llm.text import Words, symbols
from tests.llm import brute

DRAW = random.Random(11)
WORDS = ["".join(DRAW.choices("abcdefgh", k=DRAW.randint(2, 7))) for _ in range(200)]


def prose(n):
    return " ".join(DRAW.choices(WORDS, k=n))


TEXTS = [
    None, "", " ", " \n\t ", "one", "  two  spaces ", "a\tb\nc", "<s> <unk> <0x41> </s>", "▁a ▁b▁",
    "x" * 3000, "日本語のテキスト😀", "\x00\x1f\x7f", "né Ünïcode ßtraße", prose(400), prose(400),
    "a " * 700, "a b " * 40 + prose(20) + " a b" * 9, (prose(7) + " ") * 30, "k " * 11, "k " * 12,
    " ".join(DRAW.choices("ab", k=300)), "a b c a b c a b c a b", "a b c " * 4,
] + ["".join(DRAW.choices("abc de▁<>é\n", k=DRAW.randint(1, 40))) for _ in range(60)]

DOCS = "doc_id long, text string, ids array<int>, decoded string, `a.b` string, runs int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, [1], "x", "y", 1) for i, t in enumerate(TEXTS)]
    rows += [(13, TEXTS[13], None, None, None, 1), (None, "no id " * 9, None, None, None, 1)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def folder(docs, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{path}/documents.parquet")
    vectors().write.parquet(f"{path}/embeddings.parquet")
    none = str(tmp_path_factory.mktemp("empty"))
    docs.limit(0).write.parquet(f"{none}/documents.parquet")
    vectors().limit(0).write.parquet(f"{none}/embeddings.parquet")
    return path, none


def text_of(doc_id):
    return "no id " * 9 if doc_id is None else TEXTS[doc_id] or ""


def test_sentence_pieces(spark, docs, folder):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for check in (True, False):
        encoded = sentence_pieces.encode(docs, path, check)
        rows = sentence_pieces.decode(encoded, path, check).collect()
        assert len(rows) == docs.count()
        for r in rows:
            ids = library.encode(text_of(r["doc_id"]))
            assert r["ids"] == ids and r["decoded"].decode() == library.decode(ids)
    found = queries.op11_sentence_pieces(spark, folder[0]).collect()
    assert len(found) == docs.count()
    for r in found:
        ids = library.encode(text_of(r["doc_id"]))
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), brute.sha(",".join(map(str, ids))))
        assert r["decoded_sha256"] == brute.sha(library.decode(ids))
    assert queries.op11_sentence_pieces(spark, folder[1]).count() == 0


def test_any_ids_decode_as_the_library_does():
    path = public_tokenizers.path("piece_bpe_32k.model")
    vocabulary = sentence_pieces.Vocabulary(path)
    lists = [
        [DRAW.choice([DRAW.randrange(32000), DRAW.randrange(259)]) for _ in range(DRAW.randint(0, 9))]
        for _ in range(3000)
    ]
    counts = np.array(list(map(len, lists)))
    decoded = vocabulary.decode(np.array([i for ids in lists for i in ids]), counts)
    assert decoded == [t.encode() for t in vocabulary.library.decode(lists)]


def test_heap_and_rows_of_agendas_agree():
    vocabulary = sentence_pieces.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    words = [("▁" + "".join(DRAW.choices("theraionsé日z", k=DRAW.randint(1, 23)))).encode() for _ in range(3000)]
    heap = [vocabulary._packed(vocabulary.merged(w.decode())) for w in words]
    assert vocabulary.encode_words(words) == heap


def test_a_difference_from_the_library_ends_the_job():
    with pytest.raises(sentence_pieces.Mismatch):
        sentence_pieces._same("ids", [[1, 2]], [[1, 3]])


def test_periodic_runs(spark, docs, folder):
    rows = periodic_runs.periodic_runs(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        w = brute.words(text_of(r["doc_id"]))
        assert [tuple(x) for x in r["runs"]] == brute.periodic(w)
        assert r["n_words"] == len(w) and r["collapsed"] == brute.collapsed(w)
    found = queries.op13_periodic_runs(spark, folder[0]).collect()
    assert len(found) == docs.count() and any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(80))
    for r in found:
        w = brute.tiled(r["doc_id"], brute.words(text_of(r["doc_id"])))
        want = brute.periodic(w)
        best = min(((-n, s, p) for s, n, p in want), default=None)
        assert r["n_runs"] == len(want)
        own = (r["length"], r["start"], r["period"], r["exponent_milli"])
        assert own == ((-best[0], *best[1:], 1000 * -best[0] // best[2]) if best else (None,) * 4)
        assert r["runs_sha256"] == brute.sha("".join(f"{s},{n},{p}\n" for s, n, p in want))
        assert r["collapsed_sha256"] == brute.sha(brute.collapsed(w))
    assert queries.op13_periodic_runs(spark, folder[1]).count() == 0


def test_runs_of_many_short_alphabets():
    texts = []
    for _ in range(600):
        w = DRAW.choices("abcdefgh"[: DRAW.choice([1, 2, 3, 8])], k=DRAW.randint(0, 90))
        texts.append(" ".join(brute.tiled(DRAW.randrange(900), w) + w[: DRAW.randint(0, 20)]).encode())
    words = Words(texts)
    found = periodic_runs.find(symbols(words), words.bounds)
    for i, text in enumerate(texts):
        assert found.get(i, []) == brute.periodic(text.decode().split())


NUMBERS = np.random.default_rng(4)
NORMAL = (NUMBERS.normal(size=(300, 6)) * np.arange(1, 7)).astype(np.float32)
SCHEMA = "vec_id long, embedding array<float>, x string, n int, part long"


def vectors():
    from pyspark.sql import SparkSession

    rows = [(i, v) for i, v in enumerate(NORMAL.tolist())] + [(7, NORMAL[7].tolist())] * 40
    odd = [None, [], [1.0, 2.0], [float("nan")] * 6, [None] * 6, [float("inf")] * 6, [1e30] * 6]
    rows += [(1000 + i, v) for i, v in enumerate(odd)] + [(None, NORMAL[3].tolist())]
    return SparkSession.getActiveSession().createDataFrame(
        [(i, v, "x", 1, 1) for i, v in rows], SCHEMA
    )


def test_whitening(spark, folder):
    rows = queries.op12_whitening(spark, folder[0]).collect()
    x, sums, directions, values, trace = brute.whitened(NORMAL)
    n = len(x)
    assert len(rows) == 4 * 341 and {r["component"] for r in rows} == {1, 2, 3, 4}
    signs = {}
    for r in rows:
        own = np.floor(256 * NORMAL[3 if r["vec_id"] is None else r["vec_id"]].astype(float)).astype(int)
        k = r["component"] - 1
        assert r["n"] == n and r["deviation"] == int(((n * own - sums) ** 2).sum())
        want = (own - sums / n) @ directions[:, k] / np.sqrt(values[k])
        sign = signs.setdefault(k, np.sign(want * r["whitened"]))
        assert abs(r["whitened"] - sign * want) < 1e-9
        assert abs(r["explained"] - values[k] / trace) < 1e-12 and r["identity_error"] < 1e-9
    assert queries.op12_whitening(spark, folder[1]).count() == 0


def test_states_of_many_parts_are_combined_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "WIDTH", 2)
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.coalescePartitions.enabled"]
    for name, value in zip(names, ["600", "false"], strict=True):
        spark.conf.set(name, value)
    try:
        rows = whitening.whiten(vectors(), 6).where("vec_id < 300").collect()
    finally:
        for name in names:
            spark.conf.unset(name)
    x, _, _, values, trace = brute.whitened(NORMAL, 6)
    assert {r["n"] for r in rows} == {len(x)} and len(rows) == 6 * 340
    for r in rows:
        assert abs(r["explained"] - values[r["component"] - 1] / trace) < 1e-12
        assert r["identity_error"] < 1e-9


@pytest.mark.parametrize("rows", [[[1.0, 2.0]], [[1.0, 2.0], [1.0, 3.0]], [[0.0, 0.0]] * 3])
def test_whitening_without_variance(spark, rows):
    table = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    found = {(r["vec_id"], r["component"]): r for r in whitening.whiten(table).collect()}
    assert len(found) == 2 * len(rows)
    flat = len({tuple(r) for r in rows}) == 1
    assert all(found[i, 2]["whitened"] is None for i in range(len(rows)))
    assert (found[0, 1]["whitened"] is None) == flat
    assert found[0, 1]["explained"] == (None if flat else 1.0)


def test_deviation_of_large_entries(spark):
    rows = [(i, [float(i * 2**40), 1.0]) for i in range(3)] + [(9, [3.0, 2.0**20])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = whitening.whiten(table, 1).collect()
    assert len(found) == 4 and all(r["deviation"] is None for r in found if r["vec_id"] != 1)


@pytest.mark.parametrize("size", [1, 2, 9, 30])
def test_spectra_of_parts_combine(size):
    x = np.floor(256 * NUMBERS.normal(size=(200, size))).astype(np.int64)
    if size == 9:
        x[:, 3], x[:, 4] = 5, x[:, 5]
    parts = [whitening.Spectrum.empty(size) for _ in range(3)]
    for k in range(2):
        parts[k].add(x[k::2])
    total = whitening.Spectrum.unpacked(parts[2].packed())
    for part in parts[:2]:
        total.merge(whitening.Spectrum.unpacked(part.packed()))
    centred = x - x.mean(axis=0)
    scatter = centred.T @ centred
    made = total.vectors * total.values @ total.vectors.T
    assert total.n == 200 and [int(s) for s in total.sums] == x.sum(axis=0).tolist()
    assert np.abs(made - scatter).max() < 1e-7 * np.abs(scatter).max()
    assert np.abs(total.vectors.T @ total.vectors - np.eye(size)).max() < 1e-12
