"""Whole texts of Latin letters are encoded by chunks, as the library encodes them."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lakeward.llm import packing, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " ", "It's HE'LL we'd'nt 'tis a''s", "Çà et là\u0085ÑANDÚ ½ ²x3 İstanbul", "ȺȾ ɏ Ɏa ẞ",
    "tab\tline\r\nfeed\x0bform\x0cend", "unit\x1fsep \x7f nul\x00", "<|endoftext|> a <|startoftext|>b",
    "é ́x ﬁ “q” 中文 x", "x" * 300 + " y", "...!!! a.b,c 12345 a1b2", "the " * 500 + "The.", "ȺȾ Ǆ ŉ ªº µ",
]


def test_chunks_give_the_ids_of_the_library(monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_KEPT", 5)
    library = Tokenizer.from_file(PATH)
    file = token_counts.FileEncoder(PATH)
    texts = [t.encode() for t in TEXTS]
    for _ in range(2):
        ids = file.whole(texts, 5000)
        assert [x is None for x in ids] == [i in (4, 6, 7, 8) for i in range(len(TEXTS))]
        for text, packed in zip(TEXTS, ids, strict=True):
            want = library.encode(text, add_special_tokens=False).ids
            assert packed is None or np.frombuffer(packed, "<u4").tolist() == want
    assert file.whole([b"a " * 5001], 5000) == [None]


def test_texts_left_to_the_pieces_keep_their_place():
    library = Tokenizer.from_file(PATH)
    file = token_counts.FileEncoder(PATH)
    encoder = packing.Encoder(lambda words: file.packed([w.decode() for w in words]))
    ids, counts = packing._ids(file, encoder, [t.encode() for t in TEXTS])
    parts = np.split(ids, np.cumsum(counts)[:-1])
    want = [library.encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert [p.tolist() for p in parts] == want


def test_merges_are_asked_for_once_per_token():
    file = token_counts.FileEncoder(PATH)
    asked, merged = [], file._merged
    file._merged = lambda token: asked.append(token) or merged(token)
    file.forget()
    file.whole([b"Many words, many", b"(words) MANY, more"], 100)
    assert sorted(asked) == sorted({"many", "words", "more", ",", "(", ")"})
