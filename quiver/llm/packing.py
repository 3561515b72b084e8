"""Operator 13: vector best-fit packing of documents into sequences.

A piece of ``l`` tokens needs ``(l, 1, l * l)`` of a sequence's capacities:
tokens, documents and attention cost.  Pieces go in decreasing length to the
open sequence that fits under every capacity and has the smallest weighted norm
of what is left (``rule="norm"``) or the largest weighted dot-product of need
and rest (``rule="dot"``).  A capacity weighs the share of it that all pieces
need; one that the token capacity implies can never bind and weighs nothing
(it only breaks ties).

What a piece needs depends on its length alone, so the packing is planned on
the counts of lengths (at most ``tokens`` rows, whatever the corpus): sequences
with the same content so far are one class with a first number and a count, and
a step of the plan puts pieces of one length, by rank, into a class:

    rank r of the step -> sequence first + (r - rank) // per,
                          place  offset + (r - rank) % per * length

One step ends a length or uses a class up, so a plan has at most
``3 * tokens * (sqrt(2 * tokens) + 1)`` steps (a class takes at most
``sqrt(2 * tokens)`` different lengths; 400,000 steps, 16 MB, for 2,048
tokens); tasks get it as arrays.  Ranks are counted by Spark inside (length,
salt) groups of about ``GROUP`` pieces, so a length that a third of all pieces
share is spread over many tasks, and prefix sums of the groups' counts make
them global.  Tokenised pieces are written once to the shared folder.

Edge cases: null and empty texts are one piece (the end token); repeated rows
and null ids are packed like any others; an empty table gives an empty result;
extra columns are ignored; a very long text is cut into many pieces.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, read_docs
from .vocab import BYTE_BPE, ByteBpe, cached, file_bytes

TOKENS = 2048
#: Pieces of one length that one task ranks.
GROUP = 100_000
#: Rows of one Arrow batch of tokenised pieces.
ROWS = 512
PIECES = "doc_id long, piece int, start long, length long, ids array<int>, ids_crc32 long"


def _tokenise_task(sent, tokens: int, end: int):
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        doc, piece, start, ids = zip(*rows)
        size = np.array([len(x) for x in ids], np.int64)
        flat = pa.array(np.concatenate(ids).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size),
             pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), flat),
             pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64())],
            names=["doc_id", "piece", "start", "length", "ids", "ids_crc32"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = cached(ByteBpe, sent.value)
        rows = []
        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ids = np.append(bpe.encode(text.as_py()), np.uint32(end))
                first = (len(ids) - 1) % tokens + 1
                cuts = [0, *range(first, len(ids) + 1, tokens)]
                for k in range(len(cuts) - 1):
                    rows.append((doc, k, cuts[k], ids[cuts[k]:cuts[k + 1]]))
                    if len(rows) == ROWS:
                        yield batch(rows)
                        rows = []
        if rows:
            yield batch(rows)
    return run


def tokenised_pieces(docs: DataFrame, tokens: int = TOKENS, tokenizer: str = BYTE_BPE, end: int = 0) -> DataFrame:
    """Token ids of every document and the ``end`` token, cut from the back
    into pieces of ``tokens`` (the first may be shorter)."""
    sent = docs.sparkSession.sparkContext.broadcast(file_bytes(tokenizer))
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return src.mapInArrow(_tokenise_task(sent, tokens, end), PIECES)


def plan_packing(counts: dict[int, int], tokens: int = TOKENS, documents: int | None = None, attention: int | None = None,
                 rule: str = "norm") -> np.ndarray:
    """Steps (length, rank, pieces, per, sequence, offset) for ``counts``
    pieces of each length, ordered by length and rank."""
    if rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule {rule}")
    counts = {int(k): int(n) for k, n in counts.items() if n}
    if not counts:
        return np.zeros((0, 6), np.int64)
    if min(counts) < 1 or max(counts) > tokens:
        raise ValueError("piece lengths must lie between 1 and the token capacity")
    cap = np.array([tokens, documents or tokens, attention or tokens * tokens], np.int64)
    need = lambda n: np.array([n, 1, n * n], np.int64)
    if (need(max(counts)) > cap).any():
        raise ValueError("a piece needs more than a capacity")
    binds = np.array([True, cap[1] * min(counts) < tokens, cap[2] < tokens * tokens])
    share = np.array([float(sum(need(n)[d] * c for n, c in counts.items()) / int(cap[d])) for d in range(3)])
    weight = np.where(binds, share / share[binds].sum(), 0.0)
    rest = np.zeros((64, 3), np.int64)  # what is left in each class of equal sequences
    first = np.zeros(64, np.int64)
    many = np.zeros(64, np.int64)
    used = 0  # classes
    sequences = 0
    steps = []

    def add(r: np.ndarray, at: int, n: int) -> int:
        nonlocal used, rest, first, many
        if used == len(many):
            rest, first, many = (np.concatenate([x, np.zeros_like(x)]) for x in (rest, first, many))
        rest[used], first[used], many[used] = r, at, n
        used += 1
        return used - 1

    for n in sorted(counts, reverse=True):
        v, rank, left = need(n), 0, counts[n]
        open_ = np.flatnonzero((rest[:used] >= v).all(1))
        while left:
            if len(open_):
                gap = ((rest[open_] - v) / cap) if rule == "norm" else -(rest[open_] / cap) * (v / cap)
                gap = gap ** 2 if rule == "norm" else gap
                c = open_[np.lexsort((first[open_], gap.sum(1), gap @ weight))[0]]
            else:
                fill = int((cap // v).min()) if rule == "norm" else 1
                new = -(-left // fill)
                c = add(cap, sequences, new)
                sequences += new
            fill = int((rest[c] // v).min()) if rule == "norm" else 1
            fill = min(fill, left)
            take = min(int(many[c]), left // fill)
            steps.append((n, rank, take * fill, fill, int(first[c]), int(tokens - rest[c, 0])))
            rank += take * fill
            left -= take * fill
            if take < many[c]:  # the others stay as they are
                add(rest[c].copy(), int(first[c]) + take, int(many[c]) - take)
            rest[c] -= v * fill
            many[c] = take
            if left:
                open_ = np.flatnonzero((rest[:used] >= v).all(1))
        live = (rest[:used] >= [1, 1, 1]).all(1)
        if live.sum() < used // 2:  # full classes are done with
            keep = np.flatnonzero(live)
            rest[:len(keep)], first[:len(keep)], many[:len(keep)] = rest[keep], first[keep], many[keep]
            used = len(keep)
    out = np.array(steps, np.int64)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def _place_task(sent, cols: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = sent.value
        where = {int(n): (int(lo), int(hi)) for n, lo, hi in zip(
            *np.unique(steps[:, 0], return_index=True), np.searchsorted(steps[:, 0], np.unique(steps[:, 0]), "right"))}
        for b in batches:
            size = b.column("length").to_numpy()
            rank = b.column("rank").to_numpy()
            at = np.empty(len(size), np.int64)
            for n in np.unique(size):
                lo, hi = where[int(n)]
                mine = size == n
                at[mine] = lo + np.searchsorted(steps[lo:hi, 1], rank[mine], "right") - 1
            s = steps[at]
            k = rank - s[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in cols), pa.array(s[:, 4] + k // s[:, 3]), pa.array(s[:, 5] + k % s[:, 3] * size)],
                names=[*cols, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokens: int = TOKENS, documents: int | None = None, attention: int | None = None, rule: str = "norm",
         tokenizer: str = BYTE_BPE, end: int = 0, ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids (unless ``ids`` is false), ids_crc32,
    sequence_id and offset of every piece.  ``documents`` and ``attention``
    (sum of squared lengths) bound what a sequence holds beside its tokens;
    unset, they are what ``tokens`` implies."""
    spark = docs.sparkSession
    cols = ["doc_id", "piece", "start", "length", *(["ids"] if ids else []), "ids_crc32"]
    # a piece's number in the written table is fixed from here on
    table = materialize(tokenised_pieces(docs, tokens, tokenizer, end).withColumn("_uid", F.monotonically_increasing_id()))
    counts = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}
    steps = spark.sparkContext.broadcast(plan_packing(counts, tokens, documents, attention, rule))
    salts = spark.createDataFrame([(n, math.ceil(c / GROUP)) for n, c in counts.items()], "length long, _salts long")
    p = table.select(*cols, "_uid").join(F.broadcast(salts), "length").withColumn("_salt", F.pmod(F.xxhash64("_uid"), "_salts")).drop("_salts")
    groups = p.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("length", "_salt", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    own = Window.partitionBy("length", "_salt").orderBy("_uid")
    ranked = p.withColumn("_row", F.row_number().over(own)).join(groups, ["length", "_salt"])
    ranked = ranked.select(*cols, (F.col("_before") + F.col("_row") - 1).alias("rank"))
    kinds = {f.name: f.dataType.simpleString() for f in table.schema}
    return ranked.mapInArrow(_place_task(steps, cols), ", ".join(f"{c} {kinds[c]}" for c in cols) + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its token ids, at most the token capacity each."""
    at = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(at.alias("p")).select("sequence_id", F.flatten(F.col("p.ids")).alias("ids"))


def op13_vector_packing(spark, sf_dir: str) -> DataFrame:
    p = pack(read_docs(spark, sf_dir, "doc_id", "text"), ids=False)
    return p.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
