"""Operator 6: repeated 35-word passages by recompression.

A word goes if a window of 35 words that also starts anywhere else covers it;
every copy goes.  Texts are parsed into symbols in rounds: runs of one word
first, then, ``ROUNDS`` times, neighbouring symbols whose names fall in the
left and the right half of the alphabet become one symbol.  A name is a 64-bit
hash of what it joins, so all tasks of the cluster give equal pairs equal
names with nothing exchanged, and equal substrings get the same interior
symbols; with each symbol goes the stretch of words that decided about it
(``left``..``right``).  A window's anchor is its longest symbol decided within
it (ties: largest name, leftmost): equal windows have equal anchors.

Spark then counts the anchors' names globally (:mod:`repeats`): names that
occur once are dropped, runs of windows equal in all they cover are collapsed
and thereby verified, and what is left, where copies begin, end or differ, is
verified window by window with 128-bit digests.  Windows without a decided
symbol (inside long runs) are their own anchors.

Edge cases: null and empty texts have no words (the digest is that of the
empty string); texts under 35 words are unchanged apart from white space;
copies inside one document count; rows of one doc_id are separate documents;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_VALUE, SLICE_BYTES, Prefix, Slice, materialize, mix64, read_docs, small_batches
from .repeats import Runs, candidates, classify, covered, finish, shared_filter, texts_with

_U = np.uint64
WINDOW, ROUNDS = 35, 4


def parse(words: np.ndarray, row: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Symbols after the last round: name, first word, length, left, right.
    ``begin`` and ``end`` are the word ranges of the rows; what a text's edge
    decided reaches outside the text, hence lies in no window."""
    n = len(words)
    lo = np.arange(n)
    # runs of one word; a run is decided by itself and a word either side
    new = np.ones(n, bool)
    new[1:] = (words[1:] != words[:-1]) | (row[1:] != row[:-1])
    lo = lo[new]
    size = np.diff(np.append(lo, n))
    name = mix64(words[lo] + size.astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F))
    srow = row[lo]
    left, right = lo - 1, lo + size + 1  # begin - 1 and end + 1 at the edges
    for k in range(ROUNDS):
        side = (mix64(name ^ _U((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) & _U(1)).astype(bool)
        near = srow[1:] == srow[:-1]
        pair = near & ~side[:-1] & side[1:]  # symbol i joins i + 1
        head, tail = np.append(pair, False), np.append(False, pair)
        alone = ~head & ~tail
        # a symbol left alone was decided by the neighbour it looked at
        looks_right, looks_left = alone & ~side, alone & side
        r, l_ = right.copy(), left.copy()
        i = np.flatnonzero(looks_right)
        inner = np.append(near, False)[i]
        r[i[inner]] = right[i[inner] + 1]
        r[i[~inner]] = end[srow[i[~inner]]] + 1
        i = np.flatnonzero(looks_left)
        inner = np.append(False, near)[i]
        l_[i[inner]] = left[i[inner] - 1]
        l_[i[~inner]] = begin[srow[i[~inner]]] - 1
        i = np.flatnonzero(pair)
        name = name.copy()
        name[i] = mix64(name[i] * _U(0x9E3779B97F4A7C15) + name[i + 1] + _U(k + 1))
        size = size.copy()
        size[i] += size[i + 1]
        r[i] = r[i + 1]
        keep = ~tail
        name, lo, size, left, right, srow = name[keep], lo[keep], size[keep], l_[keep], r[keep], srow[keep]
    return name, lo, size, left, right


def _longest(key: np.ndarray, i0: np.ndarray, i1: np.ndarray) -> np.ndarray:
    """Position of the largest key in each range [i0, i1), leftmost first."""
    best = [np.arange(len(key))]
    width = 1
    top = int((i1 - i0).max())
    while width * 2 <= top:
        a, b = best[-1][:-width], best[-1][width:]
        best.append(np.where(key[b] > key[a], b, a))
        width *= 2
    level = np.floor(np.log2(i1 - i0)).astype(np.int64)  # below 64: exact
    out = np.empty(len(i0), np.int64)
    for v in range(len(best)):
        at = np.flatnonzero(level == v)
        a, b = best[v][i0[at]], best[v][i1[at] - (1 << v)]
        out[at] = np.where(key[b] > key[a], b, a)
    return out


def runs_of(s: Slice) -> Runs:
    ws, we, row = s.words()
    count = np.bincount(row, minlength=s.n)
    end = np.cumsum(count)
    begin = end - count
    if not len(ws) or count.max() < WINDOW:
        e = np.zeros(0, np.int64)
        return Runs(e.astype(np.uint64), e.astype(np.uint64), e, e, e)
    words = Prefix(BYTE_VALUE[s.data])(ws, we)
    name, lo, size, left, right = parse(words, row, begin, end)
    over = Prefix(words)
    at = np.arange(len(words) - WINDOW + 1)
    at = at[row[at] == row[at + WINDOW - 1]]
    # symbols decided within a window are neighbours: left and right never decrease
    i0, i1 = np.searchsorted(left, at, "left"), np.searchsorted(right, at + WINDOW, "right")
    some = i1 > i0
    anchor = -1 - at  # its own
    if some.any():
        key = (np.minimum(size, 255).astype(np.uint64) << _U(56)) | (name >> _U(8))
        anchor[some] = _longest(key, i0[some], i1[some])
    first = np.ones(len(at), bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    b = np.flatnonzero(first)
    n = np.diff(np.append(b, len(at)))
    p, a = at[b], anchor[b]
    fp = over(p, p + n - 1 + WINDOW)
    own = a < 0
    label = np.where(own, fp, name[np.maximum(a, 0)])
    fp = np.where(own, fp, fp + (lo[np.maximum(a, 0)] - p).astype(np.uint64))
    r = row[p].astype(np.int64)
    return Runs(label, fp, p - begin[r], n, r)


def clean(text: bytes) -> tuple[int, str]:
    words = text.split()
    return len(words), hashlib.sha256(b" ".join(words)).hexdigest()


def _window_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """128-bit digests of the windows to verify, one row each."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        z, lists = batch.column("z").to_pylist(), batch.column("r")
        cut = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]) if len(z) else np.zeros(1, int)
        flat = lists.flatten()
        lo, n = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("lo", "n"))
        uid = batch.column("uid").to_numpy(zero_copy_only=False)
        first = 0
        while first < len(z):
            texts, size = [], 0
            while first + len(texts) < len(z) and size < SLICE_BYTES:
                texts.append(unpack.decompress(z[first + len(texts)], max_output_size=1 << 31))
                size += len(texts[-1])
            last = first + len(texts)
            s = Slice(first, last, np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
            ws, we, row = s.words()
            words = Prefix(BYTE_VALUE[s.data])(ws, we)
            begin = np.searchsorted(row, np.arange(last - first))
            mine = slice(int(cut[first]), int(cut[last]))
            doc = np.repeat(np.repeat(np.arange(last - first), np.diff(cut[first:last + 1])), n[mine])
            p = np.repeat(lo[mine], n[mine]) + np.arange(int(n[mine].sum())) - np.repeat(np.cumsum(n[mine]) - n[mine], n[mine])
            at = begin[doc] + p
            h1, h2 = (Prefix(x)(at, at + WINDOW).view(np.int64) for x in (words, mix64(words ^ _U(0x2545F4914F6CDD1D))))
            yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), pa.array(uid[first:last][doc]), pa.array(p.astype(np.int32))],
                                             names=["h1", "h2", "uid", "lo"])
            first = last


def _finish_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for b in batches:
        rows = []
        for z, r in zip(b.column("z").to_pylist(), b.column("r").to_pylist(), strict=True):
            words = unpack.decompress(z, max_output_size=1 << 31).split()
            gone = covered(len(words), [(x["lo"], x["n"]) for x in r or []], WINDOW)
            kept = b" ".join([words[i] for i in np.flatnonzero(~gone)]) if gone.any() else b" ".join(words)
            rows.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
        cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:2]), pa.array(cols[2], pa.string())],
                                         names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def removed_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents with candidates, windows that go: uid, first, number)."""
    cand = candidates(docs, runs_of, clean, shared_filter(docs, runs_of))
    runs = classify(cand)
    whole = runs.filter("copied").select("uid", "lo", "n")
    look = runs.filter("look").select("uid", "lo", "n")  # one run of each kind, with the others of its name
    windows = materialize(texts_with(look, cand, "lo", "n").select("uid", "z", "r").mapInArrow(_window_task, "h1 long, h2 long, uid long, lo int"))
    twice = windows.groupBy("h1", "h2").agg(F.count("*").alias("c")).filter("c > 1").select("h1", "h2")
    part = windows.join(twice, ["h1", "h2"], "left_semi").select("uid", "lo", F.lit(1).alias("n"))
    return cand, materialize(whole.unionByName(part))


def remove_passages(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    with small_batches(docs.sparkSession):
        cand, spans = removed_spans(docs)
    return finish(cand, spans, _finish_task, "doc_id long, n_words long, n_removed long, kept_sha256 string",
                  [F.col("size").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256")])


def op6_recompression(spark, sf_dir: str) -> DataFrame:
    return remove_passages(read_docs(spark, sf_dir, "doc_id", "text"))
