"""The compressed index against plain searches, and its size."""

import numpy as np

from lakeward.llm.fm_index import FMIndex, suffix_order

DRAW = np.random.default_rng(8)


def sample():
    parts = [
        np.append(DRAW.integers(1, DRAW.integers(2, 6), DRAW.integers(1, 30)), 0)
        for _ in range(DRAW.integers(1, 6))
    ]
    return np.concatenate(parts).astype(np.int32)


def places(text, part):
    return [i for i in range(len(text) - len(part) + 1) if text[i : i + len(part)].tolist() == part]


def test_order_places_and_matching_statistics():
    for _ in range(60):
        text = sample()
        order = suffix_order(text)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        index = FMIndex(text)
        assert index.locate(np.arange(len(text))).tolist() == order.tolist()
        ends = np.array([e for e in range(4, len(text) + 1) if 0 not in text[e - 4 : e]], int)
        if not ends.size:
            continue
        for e, matched, low, high in zip(ends, *index.match(text, ends, 4), strict=True):
            parts = [text[e - k : e].tolist() for k in range(1, 5)]
            assert matched == max((len(p) for p in parts if len(places(text, p)) > 1), default=0)
            if matched == 4:
                assert sorted(index.locate(np.arange(low, high))) == places(text, parts[3])


def test_the_index_is_smaller_than_the_text():
    text = DRAW.integers(1, 50_000, 200_000).astype(np.int32)
    text[::60] = 0
    text[-1] = 0
    index = FMIndex(text)
    planes = [*index.tree.planes, index.known]
    size = sum(p.words.nbytes + p.before.nbytes for p in planes) + index.places.nbytes
    assert size < text.nbytes
