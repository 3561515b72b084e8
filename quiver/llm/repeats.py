"""Shared plan of the two substring operators: find every fixed-length window
that occurs more than once in the corpus without shipping every window.

Each window is assigned to an anchor inside it by a rule that looks at the
window's content only, so equal windows have equal anchors.  Consecutive
windows of one anchor form a run: (name of the anchor, fingerprint of all the
run covers, first window, number of windows).

A. :func:`shared_filter`: names are counted.  Tasks send each name once for a
   few MB of text, as packed 64-bit arrays dealt by name, so a name in a third
   of all documents costs one entry a flush.  Names seen twice set bits of a
   filter of fixed size (a part for every bucket); a fuller filter lets more
   runs pass, it never loses one.
B. :func:`candidates`: the second scan writes, once, every document with the
   runs that pass, and its text (compressed) if there are any.
C. :func:`classify`: runs equal in name and fingerprint collapse to one
   representative; only names with several different runs need a closer look.

The operators do that closer look by their own methods.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Slice, materialize, mix64, slices

_U = np.uint64
#: Bits of the filter of shared names: 16 MB, whatever the input.
FILTER_BITS = 1 << 27
FLUSH = 1 << 20  # names held by a task before it sends them


class Runs:
    """Arrays over the runs of a slice, ordered by row and first window."""

    def __init__(self, name, fp, lo, n, row, **more):
        self.name, self.fp, self.lo, self.n, self.row = name, fp, lo, n, row
        self.__dict__.update(more)


def _pack_task(find: Callable[[Slice], Runs], buckets: int):
    def flush(held):
        names, count = np.unique(np.concatenate(held), return_counts=True)
        bucket = (names >> _U(32)) % _U(buckets)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
        out = {"bucket": [], "once": [], "twice": []}
        for b in np.flatnonzero(np.diff(cut)):
            at = order[cut[b]:cut[b + 1]]
            out["bucket"].append(int(b))
            out["once"].append(names[at[count[at] == 1]].tobytes())
            out["twice"].append(names[at[count[at] > 1]].tobytes())
        return pa.RecordBatch.from_arrays([pa.array(out["bucket"], pa.int32()), pa.array(out["once"], pa.binary()),
                                           pa.array(out["twice"], pa.binary())], names=list(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for s in slices(b.column("text")):
                x = find(s).name
                held.append(x)
                size += len(x)
                if size >= FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)
    return run


def _bits_of(names: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix64(names)
    return (x % _U(bits)).astype(np.int64), ((x >> _U(32)) % _U(bits)).astype(np.int64)


def _bucket_task(bits: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        twice = [np.frombuffer(x, np.uint64) for x in pdf["twice"]]
        once = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["once"]] + [np.unique(t) for t in twice])
        names, count = np.unique(once, return_counts=True)
        shared = np.concatenate([names[count > 1], *twice])
        seg = np.zeros(bits, np.uint8)
        for at in _bits_of(shared, bits):
            seg[at] = 1
        return pd.DataFrame({"bucket": [int(pdf["bucket"].iloc[0])], "seg": [np.packbits(seg).tobytes()]})
    return run


def shared_filter(docs: DataFrame, find: Callable[[Slice], Runs]) -> dict:
    """The bit filter of names that occur at least twice."""
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(64, FILTER_BITS // buckets // 8 * 8)
    packed = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_pack_task(find, buckets), "bucket int, once binary, twice binary")
    rows = packed.groupBy("bucket").applyInPandas(_bucket_task(bits), "bucket int, seg binary").collect()  # FILTER_BITS in all
    data = np.zeros((buckets, bits // 8), np.uint8)
    for r in rows:
        data[r["bucket"]] = np.frombuffer(r["seg"], np.uint8)
    return {"buckets": buckets, "bits": bits, "data": data.ravel()}


def passes(flt: dict, names: np.ndarray) -> np.ndarray:
    base = ((names >> _U(32)) % _U(flt["buckets"])).astype(np.int64) * flt["bits"]
    ok = np.ones(len(names), bool)
    for at in _bits_of(names, flt["bits"]):
        at = at + base
        ok &= ((flt["data"][at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)
    return ok


CANDIDATES = "doc_id long, size long, sha string, z binary, name array<long>, fp array<long>, lo array<int>, n array<int>"


def _candidate_task(find, clean, sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flt, pack = sent.value, zstandard.ZstdCompressor(level=1)
        for b in batches:
            for s in slices(b.column("text")):
                r = find(s)
                ok = passes(flt, r.name)
                cut = np.searchsorted(r.row[ok], np.arange(s.n + 1)).astype(np.int32)
                some = np.diff(cut) > 0
                raw = s.data.tobytes()
                text = [raw[s.start[i]:s.start[i + 1]] for i in range(s.n)]
                done = [None if some[i] else clean(text[i]) for i in range(s.n)]
                lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x)) for x in
                         (r.name[ok].view(np.int64), r.fp[ok].view(np.int64), r.lo[ok].astype(np.int32), r.n[ok].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(s.lo, s.n), pa.array([d[0] if d else None for d in done], pa.int64()),
                     pa.array([d[1] if d else None for d in done], pa.string()),
                     pa.array([pack.compress(t) if some[i] else None for i, t in enumerate(text)], pa.binary()), *lists],
                    names=["doc_id", "size", "sha", "z", "name", "fp", "lo", "n"])
    return run


def candidates(docs: DataFrame, find, clean, flt: dict) -> DataFrame:
    """Every document once, with a row number of its own (``uid``): ``size``
    and ``sha`` if no run passes, else ``z`` and its runs."""
    sent = docs.sparkSession.sparkContext.broadcast(flt)
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return materialize(src.mapInArrow(_candidate_task(find, clean, sent), CANDIDATES).withColumn("uid", F.monotonically_increasing_id()))


def classify(cand: DataFrame) -> DataFrame:
    """Runs that repeat or may: uid, lo, n, ``copied`` (others are equal in name
    and fingerprint), ``rep`` (the first of those: smallest doc_id, then
    position), and ``look`` (a ``rep`` whose name has other runs too), with
    name and ord."""
    runs = (cand.filter("z is not null")  # first window and number share a long: a run has at most a window's units of windows
            .select("uid", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("ord"),
                    F.explode(F.arrays_zip("name", "fp", F.transform("lo", lambda x, i: x * F.lit(128).cast("long") + F.get("n", i)).alias("at"))).alias("r"))
            .select("uid", "ord", "r.*"))
    same = materialize(runs.groupBy("name", "fp").agg(F.count("*").alias("copies"), F.min(F.struct("ord", "uid", "at")).alias("first")))
    kinds = same.groupBy("name").agg(F.count("*").alias("kinds"))
    known = (same.join(kinds, "name").filter("copies > 1 or kinds > 1")
             .select("name", "fp", F.col("copies") > 1, F.col("kinds") > 1, "first.*").toDF("name", "fp", "copied", "mixed", "ord", "u0", "a0"))
    rep = (F.col("uid") == F.col("u0")) & (F.col("at") == F.col("a0"))
    look = rep & F.col("mixed")
    return materialize(runs.drop("ord").join(known, ["name", "fp"])
                       .select("uid", (F.col("at") / 128).cast("int").alias("lo"), (F.col("at") % 128).cast("int").alias("n"), "copied",
                               rep.alias("rep"), look.alias("look"), F.when(look, F.col("name")).alias("name"), F.when(look, F.col("ord")).alias("ord"))
                       .filter("copied or look"))


def texts_with(rows: DataFrame, cand: DataFrame, *cols: str) -> DataFrame:
    """The documents of ``rows`` (uid, ...) with their compressed text and
    their rows as a list ``r``; a document's list is bounded by its length."""
    lists = rows.groupBy("uid").agg(F.collect_list(F.struct(*cols)).alias("r"))
    return lists.join(cand.select("uid", "z"), "uid")


def covered(size: int, spans: list[tuple[int, int]], window: int) -> np.ndarray:
    """Which of ``size`` units lie in a window of the spans (first, number)."""
    edge = np.zeros(size + 1, np.int32)
    if spans:
        lo, n = (np.array(x, np.int64) for x in zip(*spans, strict=True))
        np.add.at(edge, lo, 1)
        np.add.at(edge, lo + n - 1 + window, -1)
    return np.cumsum(edge)[:size] > 0


def finish(cand: DataFrame, spans: DataFrame, finish_task, schema: str, clean_cols: list) -> DataFrame:
    """Results of all documents: those without candidates as written by the
    scan, the others from their text and spans (uid, lo, n)."""
    lists = spans.groupBy("uid").agg(F.collect_list(F.struct("lo", "n")).alias("r"))
    touched = cand.filter("z is not null").select("uid", "doc_id", "z").join(lists, "uid", "left")
    return (touched.select("doc_id", "z", "r").mapInArrow(finish_task, schema)
            .unionByName(cand.filter("z is null").select("doc_id", *clean_cols)))
