"""Words are cut where no merge can cross, and each part is encoded once."""

import numpy as np
import public_tokenizers
import pytest

from lakeward.llm.sentence_pieces import Vocabulary

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "The cat, the cat. (the cat) 'cat' cat's", "", " ", "a.b,c;d->e _{x}_ f(x)__,__ 3.14 -2e10",
    "x\x01\x02, \x7f.", "état, Ünï. 中文,abc 。x", "\U0001f600, à.", "tab\tand\nline,\r\n.",
    ",,,...;;;" * 40, "w" * 200 + "," + "w" * 200, "▁,▁▁.a▁", "don't \\frac{1}{2} $x_{i}$",
]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH)


def test_cut_words_give_the_ids_of_the_library(vocabulary):
    ids, counts = vocabulary.encode(TEXTS)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [vocabulary.library.encode(t) for t in TEXTS]
    assert vocabulary.decode(ids, counts) == [
        vocabulary.library.decode(vocabulary.library.encode(t)).encode() for t in TEXTS
    ]


def test_every_pair_of_ascii_characters(vocabulary):
    signs = [chr(c) for c in range(1, 128)]
    texts = [f"x{a}{b}y {a}{b}" for a in signs for b in signs]
    ids, counts = vocabulary.encode(texts)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == vocabulary.library.encode(texts)


def test_a_word_is_encoded_once_whatever_stands_beside_it(monkeypatch):
    vocabulary, asked = Vocabulary(PATH), []
    encode = vocabulary.encode_words
    monkeypatch.setattr(vocabulary.cache, "encode", lambda w: asked.extend(w) or encode(w))
    vocabulary.encode(["one two, two. two; two"])
    assert sorted(w.decode() for w in asked) == sorted(["▁one", "▁two", ",", ".", ";"])
