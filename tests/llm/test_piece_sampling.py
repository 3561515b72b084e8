import itertools
import random

import numpy as np
import pytest

from quiver.llm import piece_sampling as q
from helpers import ODD, by_id, docs, empty, words


@pytest.fixture(scope="module")
def tables():
    return q.load_tables()


def test_round_trip_and_reproducible(spark):
    r = random.Random(1)
    texts = [*ODD, "a\r\nb", " " * 70 + "z", "漢字 😀", "  two  spaces ", *[words(r, 50) for _ in range(20)]]
    d = docs(spark, texts)
    one = by_id(q.sample_pieces(d), "ids", "lossless", "n_pieces", "n_bytes")
    assert all(x[1] and len(x[0]) == x[2] and x[3] == len((t or "").encode()) for t, x in zip(texts, [one[i] for i in range(len(texts))]))
    assert one == by_id(q.sample_pieces(d.repartition(1)), "ids", "lossless", "n_pieces", "n_bytes")
    assert one[6][0] != one[7][0] or one[6][2] > 0  # equal texts, different keys
    assert q.sample_pieces(empty(spark)).count() == 0


def test_decodes_like_the_library(tables):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=q.MODEL)
    texts = ["Hello there, world", "naïve café\nline two", "x  y", "tabs\tand 12345"]
    ids, off = q.encode(tables, texts, np.arange(4))
    for i, t in enumerate(texts):
        assert sp.decode(ids[off[i]:off[i + 1]].tolist()) == t


def test_samples_follow_the_lattice(tables):
    """Frequencies of a word's segmentations match their weights."""
    n, word = 20000, "ened"
    ids, off = q.encode(tables, [word] * n, np.arange(n))
    seen = {}
    for i in range(n):
        k = tuple(ids[off[i]:off[i + 1]].tolist())
        seen[k] = seen.get(k, 0) + 1
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=q.MODEL)
    text, weight = "▁" + word, {}
    for cut in itertools.product([0, 1], repeat=len(text) - 1):
        parts, last = [], 0
        for k, c in enumerate([*cut, 1], 1):
            if c:
                parts.append(text[last:k])
                last = k
        pieces = [sp.piece_to_id(p) for p in parts]
        if sp.unk_id() not in pieces:
            weight[tuple(pieces)] = float(np.prod([(2 - sp.get_score(x)) ** -0.7 for x in pieces]))
    total = sum(weight.values())
    assert set(seen) <= set(weight)
    for k, w in weight.items():
        p = w / total
        assert abs(seen.get(k, 0) / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-3
