"""Operator 8: quality classifier, histogram gradient-boosted trees over
document statistics.

Every document becomes a short vector of statistics of its whole text (one
scan, written once).  Trees are fitted on labelled rows whose
``crc32(doc_id) mod 3`` is not 1; the training set is a bounded sample of
them (``max_train`` rows, the smallest by a hash of the id).  The fitted trees
are complete binary trees in flat arrays (feature, threshold, leaf value), so
a batch of documents is scored with one gather a level.

Neither labels nor lang, source or doc_id enter a score.

Edge cases: null and empty texts are vectors of zeros and get a score like any
other; labels without a document are ignored, repeated ones count each time;
without labelled rows, or with one class only, the score is the (smoothed)
share of label 1; repeated documents are returned as often as they occur; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix64, per_doc_sum, read_docs, slices
from .docstats import base_counts, distinct_per_doc

FEATURES = ("log_words", "log_chars", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share",
            "digit_share", "shout_share", "stop_share", "bar_share", "line_words", "distinct_share", "longest_word",
            "wide_share", "space_share", "short_share", "colon_share", "joined_symbol_share")


def _flags(*chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    for c in chars:
        t[list(c)] = True
    return t


_UPPER = _flags(bytes(range(65, 91)))
_LETTER = _flags(bytes(range(65, 91)), bytes(range(97, 123)))
_DIGIT = _flags(b"0123456789")
_STOP = _flags(b".,;")
_MARK = _flags(b"#*$%&<>")


def vectors(s) -> np.ndarray:
    """(rows, len(FEATURES)) float32."""
    c = base_counts(s)
    data, n = s.data, s.n
    total = lambda t: per_doc_sum(t[data], s.start).astype(float)
    chars = per_doc_sum((data & 0xC0) != 0x80, s.start).astype(float)
    words = c["n_words"].astype(float)
    per_char, per_word = 1 / np.maximum(chars, 1), 1 / np.maximum(words, 1)
    row, length = c["_wrow"], c["_wlen"]
    longest = np.zeros(n)
    np.maximum.at(longest, row, length)
    distinct = distinct_per_doc(mix64(c["_word"] ^ c["_salt"][row]), row, n)
    joined = np.zeros(len(data), bool)
    if len(data) > 1:
        joined[1:] = _MARK[data[1:]] & _LETTER[data[:-1]]
    x = np.stack([
        np.log1p(words), np.log1p(chars), c["word_chars"] * per_word, c["n_symbols"] * per_char,
        c["n_dup_lines"] / np.maximum(c["n_lines"], 1), c["n_repeat_words"] * per_word,
        total(_UPPER) / np.maximum(total(_LETTER), 1), total(_DIGIT) * per_char, total(_flags(b"!")) * per_word,
        total(_STOP) * per_word, total(_flags(b"|")) * per_word, words / np.maximum(c["n_lines"], 1), distinct * per_word,
        np.minimum(longest, 200), 1 - total(_flags(bytes(range(128)))) / np.maximum(np.diff(s.start), 1),
        total(_flags(b" \t\n\x0b\x0c\r")) * per_char, np.bincount(row[length <= 2], minlength=n) * per_word,
        total(_flags(b":")) * per_word, per_doc_sum(joined, s.start) * per_word], axis=1)
    x[np.diff(s.start) == 0] = 0
    return x.astype(np.float32)


def _vector_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for s in slices(b.column("text")):
            x = vectors(s)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(s.lo, s.n), lists], names=["doc_id", "x"])


def document_vectors(docs: DataFrame) -> DataFrame:
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return src.mapInArrow(_vector_task, "doc_id long, x array<float>")


class Trees:
    """Boosted complete binary trees; node i has children 2i+1 and 2i+2."""

    def __init__(self, base: float, depth: int, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray):
        self.base, self.depth, self.feature, self.cut, self.leaf = base, depth, feature, cut, leaf

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += v[node - (len(f))]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
        ridge: float = 1.0, least: int = 20) -> Trees:
    """Logistic boosting on per-feature histograms of quantile bins."""
    n_in = (1 << depth) - 1
    prior = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    base = float(np.log(prior / (1 - prior)))
    if len(y) == 0 or y.min() == y.max():
        return Trees(base, depth, np.zeros((0, n_in), int), np.zeros((0, n_in)), np.zeros((0, n_in + 1)))
    n, k = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(k)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)  # bin b: value <= edge b
    raw = np.full(n, base)
    F_, C_, V_ = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        feature, cut = np.zeros(n_in, int), np.full(n_in, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            at = node - first
            best = np.full(width, 1e-6)
            pick_f, pick_b = np.zeros(width, int), np.full(width, -1)
            for j in range(k):
                key = at * bins + binned[:, j]
                G, H, N = (np.bincount(key, weights=w, minlength=width * bins).reshape(width, bins) for w in (g, h, None))
                GL, HL, NL = G.cumsum(1), H.cumsum(1), N.cumsum(1)
                GT, HT, NT = GL[:, -1:], HL[:, -1:], NL[:, -1:]
                gain = GL ** 2 / (HL + ridge) + (GT - GL) ** 2 / (HT - HL + ridge) - GT ** 2 / (HT + ridge)
                gain[(NL < least) | (NT - NL < least)] = 0
                gain[:, len(edges[j]):] = 0
                b = gain.argmax(1)
                better = gain[np.arange(width), b] > best
                best[better] = gain[np.arange(width), b][better]
                pick_f[better], pick_b[better] = j, b[better]
            for i in range(width):
                if pick_b[i] >= 0:
                    feature[first + i], cut[first + i] = pick_f[i], edges[pick_f[i]][pick_b[i]]
            go = pick_b[at] >= 0
            right = go & (binned[np.arange(n), pick_f[at]] > pick_b[at])
            node = 2 * node + 1 + right
        at = node - n_in
        leaf = rate * np.bincount(at, weights=g, minlength=n_in + 1) / (np.bincount(at, weights=h, minlength=n_in + 1) + ridge)
        raw += leaf[at]
        F_.append(feature), C_.append(cut), V_.append(leaf)
    return Trees(base, depth, np.array(F_), np.array(C_), np.array(V_))


def _score_task(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Trees(**model.value)
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) if b.num_rows else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(trees.score(x))],
                                             names=["doc_id", "held_out", "score"])
    return run


def quality_scores(docs: DataFrame, labels: DataFrame, max_train: int = 50_000) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    x = materialize(document_vectors(docs)).withColumn("held_out", held)
    known = labels.select("doc_id", F.col("quality").cast("double").alias("y")).filter("doc_id is not null and y is not null")
    train = (x.filter(~F.col("held_out")).join(known, "doc_id")
             .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_train).select("x", "y").toPandas())
    xs = np.array(train["x"].tolist(), np.float32).reshape(len(train), len(FEATURES))
    sent = spark.sparkContext.broadcast(vars(fit(xs, train["y"].to_numpy(float))))
    scored = x.mapInArrow(_score_task(sent), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_quality_model(spark, sf_dir: str) -> DataFrame:
    return quality_scores(read_docs(spark, sf_dir, "doc_id", "text"),
                          read_docs(spark, sf_dir, "doc_id", "quality", table="labels"))
