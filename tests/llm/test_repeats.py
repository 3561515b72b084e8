import collections
import hashlib
import random

import numpy as np

from quiver.llm import recompression as rec
from quiver.llm import repeats
from quiver.llm import substring_dedup as sub
from helpers import ODD, by_id, docs, empty, words


def brute_bytes(texts, w=100):
    first, out = {}, {}
    raw = [(t or "").encode() for t in texts]
    for i, b in enumerate(raw):
        for k in range(len(b) - w + 1):
            first.setdefault(b[k:k + w], (i, k))
    for i, b in enumerate(raw):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - w + 1):
            if first[b[k:k + w]] != (i, k):
                gone[k:k + w] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def brute_words(texts, w=35):
    split = [(t or "").encode().split() for t in texts]
    count = collections.Counter(tuple(x[k:k + w]) for x in split for k in range(len(x) - w + 1))
    out = {}
    for i, x in enumerate(split):
        gone = [False] * len(x)
        for k in range(len(x) - w + 1):
            if count[tuple(x[k:k + w])] > 1:
                gone[k:k + w] = [True] * w
        out[i] = (len(x), sum(gone), hashlib.sha256(b" ".join(a for a, g in zip(x, gone) if not g)).hexdigest())
    return out


def corpus(seed):
    r = random.Random(seed)
    base = [words(r, 90, 60) for _ in range(5)]
    texts = [t if t is None else t[:1500] for t in ODD] + ["x " * 400, "a b " * 60, "ab" * 300, "x" * 99, "x" * 100, "x" * 101, "q " * 40 + words(r, 50), "q " * 40 + words(r, 40)]
    for _ in range(90):
        b = r.choice(base).split()
        kind = r.random()
        if kind < 0.3:  # a copy with one word changed
            b[r.randrange(len(b))] = "zzz"
            texts.append(" ".join(b))
        elif kind < 0.4:
            texts.append(" ".join(b))
        else:
            k = r.randrange(60)
            texts.append(words(r, r.randrange(40)) + " " + " ".join(b[k:k + r.randrange(10, 60)]) + "\n" + words(r, r.randrange(40)))
    return texts


def test_bytes_equal_brute_force(spark):
    texts = corpus(7)
    got = by_id(sub.remove_repeats(docs(spark, texts)), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute_bytes(texts)
    assert sub.remove_repeats(empty(spark)).count() == 0


def test_words_equal_brute_force(spark):
    texts = corpus(8)
    got = by_id(rec.remove_passages(docs(spark, texts)), "n_words", "n_removed", "kept_sha256")
    assert got == brute_words(texts)
    assert rec.remove_passages(empty(spark)).count() == 0


def test_results_do_not_depend_on_the_filter(spark, monkeypatch):
    """A full filter lets every run pass; the result is the same."""
    texts = corpus(9)[:60]
    monkeypatch.setattr(repeats, "FILTER_BITS", 64)
    monkeypatch.setattr(repeats, "FLUSH", 50)
    assert by_id(sub.remove_repeats(docs(spark, texts)), "n_removed") == {i: x[1:2] for i, x in brute_bytes(texts).items()}
    assert by_id(rec.remove_passages(docs(spark, texts)), "n_removed") == {i: x[1:2] for i, x in brute_words(texts).items()}


def test_null_and_repeated_ids(spark):
    t = words(random.Random(3), 60)
    d = spark.createDataFrame([(None, t), (5, t), (5, t), (2, t)], "doc_id long, text string")
    got = sorted((r["doc_id"] is None, r["doc_id"], r["n_removed"]) for r in sub.remove_repeats(d).filter("doc_id is not null").collect())
    assert [x[2] for x in got] == [0, len(t), len(t)]
    assert [r["n_removed"] for r in sub.remove_repeats(d).filter("doc_id is null").collect()] == [len(t)]
    assert {r["n_removed"] for r in rec.remove_passages(d).collect()} == {60}


def test_deep_shallow_order():
    r = np.random.default_rng(2)
    rows = r.integers(97, 99, (400, 40)).astype(np.uint8)
    rows[:, :20] = rows[0, :20]
    rows[100:140] = rows[3]
    group = r.integers(0, 4, 400)
    order, lcp = sub.sort_strings(rows, group)
    keyed = [(group[i], rows[i].tobytes()) for i in order]
    assert keyed == sorted(keyed)
    for a, b, common in zip(order, order[1:], lcp[1:]):
        if group[a] == group[b]:
            d = np.flatnonzero(rows[a] != rows[b])
            assert common == (d[0] if len(d) else 40)


def test_equal_words_get_equal_symbols():
    r = np.random.default_rng(5)
    common = r.integers(1, 50, 200).astype(np.uint64)
    a, b = (np.concatenate([r.integers(1, 50, n).astype(np.uint64), common, r.integers(1, 50, 60).astype(np.uint64)]) for n in (40, 77))
    inner = []
    for x, n in ((a, 40), (b, 77)):
        row = np.zeros(len(x), np.int64)
        name, lo, size, left, right = rec.parse(x, row, np.array([0]), np.array([len(x)]))
        assert (np.diff(left) >= 0).all() and (np.diff(right) >= 0).all()
        assert lo[0] == 0 and (lo[1:] == (lo + size)[:-1]).all() and (lo + size)[-1] == len(x)
        ok = (left >= n) & (right <= n + 200)
        inner.append(list(zip(name[ok].tolist(), (lo[ok] - n).tolist(), size[ok].tolist(), strict=True)))
    assert inner[0] == inner[1] and len(inner[0]) > 20
