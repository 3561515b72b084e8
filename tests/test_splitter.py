"""The overlapping splitter against a plain Python version."""

import random
import re

import pytest

from quiver.operators import ingest


def _pieces(text, size):
    out = []
    for p in re.split(r"\n\s*\n", text, flags=re.ASCII):
        w = p.split()
        if len(w) <= size:
            out.append(w)
            continue
        for s in re.split("\x01", re.sub(r"([.!?])\s+", "\\1\x01", p, flags=re.ASCII)):
            w = s.split()
            out += [w[i:i + size] for i in range(0, len(w), size)]
    return [w for w in out if w]


def _split(text, size, overlap):
    chunks, open_, repeated = [], [], 0
    for piece in _pieces(text, size):
        if open_ and sum(map(len, open_)) + len(piece) > size:
            chunks.append((open_, repeated))
            room, keep = min(overlap, size - len(piece)), []
            for old in reversed(open_):
                if sum(map(len, keep)) + len(old) > room:
                    break
                keep.insert(0, old)
            open_, repeated = keep, sum(map(len, keep))
        open_ = open_ + [piece]
    if open_:
        chunks.append((open_, repeated))
    return [(k, sum(map(len, c)), r, " ".join(w for p in c for w in p)) for k, (c, r) in enumerate(chunks)]


def _text(rnd):
    paras = []
    for _ in range(rnd.randint(0, 6)):
        sents = [" ".join(f"w{rnd.randint(0, 99)}" for _ in range(rnd.choice([1, 2, 3, 5, 30]))) + rnd.choice(".!?,")
                 for _ in range(rnd.randint(0, 7))]
        paras.append(rnd.choice([" ", "\n", "  "]).join(sents))
    return rnd.choice(["\n\n", "\n \n", "\n\n\n\t\n"]).join(paras)


@pytest.mark.parametrize("size,overlap", [(10, 0), (10, 4), (10, 9), (1, 0), (25, 12)])
def test_split_equals_plain_python(spark, size, overlap):
    rnd = random.Random(size * 31 + overlap)
    texts = [_text(rnd) for _ in range(60)] + ["", "  \n\n \n", None, "one", "a b. c d.\n\ne", "x " * 3000, "y. " * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in ingest.split_documents(df, size=size, overlap=overlap).collect():
        got.setdefault(r.doc_id, []).append((r.chunk_no, r.n_words, r.n_overlap, r.text))
    want = {i: _split(t, size, overlap) for i, t in enumerate(texts) if t and t.split()}
    assert {i: sorted(c) for i, c in got.items()} == want
    assert all(n <= size for c in got.values() for _, n, _, _ in c)


def test_split_arguments_and_clashing_columns(spark):
    df = spark.createDataFrame([("k", "a b c", 1, 2)], "c string, text string, chunk_no int, _pieces int")
    rows = ingest.split_documents(df, id_col="c", size=2, overlap=1).collect()
    assert [(r.c, r.chunk_no, r.text) for r in rows] == [("k", 0, "a b"), ("k", 1, "c")]
    assert ingest.split_documents(df.limit(0), id_col="c", size=2).count() == 0
    for size, overlap in ((0, 0), (5, 5), (5, -1)):
        with pytest.raises(ValueError):
            ingest.split_documents(df, id_col="c", size=size, overlap=overlap)
