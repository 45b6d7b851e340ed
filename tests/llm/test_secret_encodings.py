"""The randomness battery on planted tokens of every encoding, and on ordinary runs."""

import base64
import random
import uuid

import corpus_pipeline
from lakeward.llm import secret_scan

DRAW = random.Random(11)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def drawn(symbols, n):
    return "".join(DRAW.choices(symbols, k=n))


TOKENS = [
    drawn(UPPER + "234567", 32),
    drawn(UPPER.lower() + "234567", 32),
    drawn(UPPER.lower() + "0123456789", 32),
    drawn(UPPER + "0123456789", 32),
    "".join(DRAW.choice((c, c.upper())) for c in drawn("0123456789abcdef", 40)),
    str(uuid.UUID(int=DRAW.getrandbits(128))),
    str(uuid.UUID(int=DRAW.getrandbits(128))).upper(),
    "-".join(drawn(UPPER + "0123456789", 5) for _ in range(5)),
    drawn(UPPER + UPPER.lower() + "0123456789", 40),
    drawn(UPPER + UPPER.lower(), 28),
    drawn(UPPER + UPPER.lower() + "+/", 28),
    base64.b64encode(DRAW.randbytes(48)).decode(),
    base64.urlsafe_b64encode(DRAW.randbytes(48)).decode(),
    drawn("0123456789abcdef", 16),
    drawn(UPPER + UPPER.lower() + "0123456789", 20),
    drawn(UPPER.lower() + "0123456789", 18),
]
ORDINARY = [
    "getUserAccountByIdentifierAndPassword2", "InternationalizationConfigurationManager",
    "usr/local/lib/python3/site-packages/requests", "thisisaverylongwordwithoutanyspaces",
    "1234567890123456789012345", "https://example.org/a", "some_function_name_with_number_12",
]


def test_every_encoding_is_found_and_redacted(spark):
    rows = [(i, f"see {t} for it") for i, t in enumerate(TOKENS + ORDINARY)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {
        r["doc_id"]: [(s["start"], s["end"]) for s in r["_spans"] if s["kind"] == 3]
        for r in secret_scan.find_secrets(docs).collect()
    }
    missed = [t for i, t in enumerate(TOKENS) if (4, 4 + len(t)) not in spans[i]]
    assert missed == []
    assert [t for i, t in enumerate(ORDINARY, len(TOKENS)) if spans[i]] == []
    clean = {r["doc_id"]: r["text"] for r in corpus_pipeline.secret_redaction(spark, docs, "").collect()}
    assert all(clean[i] == "see [REDACTED] for it" for i in range(len(TOKENS)))
