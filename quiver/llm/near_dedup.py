"""Operator 7: near-duplicate documents with SetSketch registers.

1. One scan turns every text into its shingle set (4 words, A-Z lower-cased;
   shorter texts are one shingle) and writes size, a 128-bit digest and a
   sketch: for each of ``M`` hash functions the minimum over the set, as an
   exponential variate on a scale of base ``BASE``, truncated to a byte.
   Sketches merge by maximum and two registers agree with probability about J.
2. Documents with equal sets form a class; only classes are compared.
3. The first registers are banded (``BANDS`` of ``ROWS``).  In a bucket every member is
   paired with a leader, the smallest id, never with all others, and goes on
   with the ``LEADERS`` leaders it shares most buckets with.  A pair goes on if
   sizes allow J >= threshold and the joint maximum-likelihood estimate from
   both sketches (the counts of larger, smaller and equal registers, given the
   exact sizes) is not below it by more than ``SLACK`` deviations of an
   ``M``-register estimate; the texts are
   then fetched and J is computed on full sets.
4. Links give components.  Only buckets that still hold several are looked at
   again, and only for pairs of different components: members outside the
   bucket's main component are held in blocks of ``BLOCK``, all its members
   stream past each block, and what size and estimate allow is verified.  So no
   cap is set on buckets or candidates, no group is held by a task, and the
   members of one large group of copies are not compared with each other.

With J = 0.8 a pair shares no band with probability 1e-7.

Edge cases: null and empty texts and texts without words have the empty set
and are linked with nothing; a null doc_id is linked with nothing (component
null, kept); rows with one doc_id count as one document; an empty table gives
an empty result; extra columns are ignored by the query and kept by
:func:`near_dedup`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BYTE_VALUE, Prefix, Slice, materialize, mix64, read_docs, slices, small_batches
from .graph import components

_U = np.uint64
M, BANDS, ROWS, BASE, RATE, TOP = 640, 40, 5, 1.2, 20.0, 254
SLACK = 4.5
LEADERS, BLOCK = 3, 512
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(s: Slice, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    low = Slice(s.lo, s.hi, _LOWER[s.data], s.start)
    ws, we, row = low.words()
    words = Prefix(BYTE_VALUE[low.data])(ws, we)
    count = np.bincount(row, minlength=s.n)
    end = np.cumsum(count)
    begin = end - count
    over = Prefix(words)
    at = np.flatnonzero(np.repeat(end, count) - np.arange(len(words)) >= k) if len(words) else np.zeros(0, np.int64)
    grams = over(at, at + k)
    cut = np.searchsorted(at, np.concatenate([begin, [len(words)]]))
    short = (count > 0) & (count < k)
    whole = over(begin, end)
    return [whole[i:i + 1] if short[i] else np.unique(grams[cut[i]:cut[i + 1]]) for i in range(s.n)]


def _functions() -> tuple[np.ndarray, np.ndarray]:
    x = mix64(np.arange(1, 2 * M + 1, dtype=np.uint64) * _U(0xA0761D6478BD642F))
    return x[:M] | _U(1), x[M:]


def sketch(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of a non-empty set: floor(1 - log_BASE of the truncated
    minimum of RATE-exponential variates)."""
    low = np.full(M, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(values), 512):
        np.minimum(low, (values[i:i + 512, None] * a + b).min(axis=0), out=low)
    x = -np.log1p(-np.minimum((low.astype(np.float64) + 0.5) * 2.0 ** -64, 1 - 2.0 ** -53)) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP + 1).astype(np.uint8)


def _sketch_task(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b2 = _functions()
        for b in batches:
            for s in slices(b.column("text")):
                sets = shingle_sets(s, k)
                with np.errstate(over="ignore"):
                    d1 = [int(mix64(x).sum(dtype=np.uint64).view(np.int64)) if len(x) else 0 for x in sets]
                    d2 = [int(mix64(x ^ _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)) if len(x) else 0 for x in sets]
                    regs = [sketch(x, a, b2).tobytes() if len(x) else b"" for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(s.lo, s.n), pa.array([len(x) for x in sets], pa.int64()),
                     pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(regs, pa.binary())],
                    names=["doc_id", "n_shingles", "d1", "d2", "regs"])
    return run


def sketches(docs: DataFrame, k: int) -> DataFrame:
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return src.mapInArrow(_sketch_task(k), "doc_id long, n_shingles long, d1 long, d2 long, regs binary")


def _bands(regs: np.ndarray) -> np.ndarray:
    """Banded registers, (rows, BANDS, ROWS)."""
    return regs[:, :BANDS * ROWS].reshape(len(regs), BANDS, ROWS).astype(np.uint64)


def _keys(banded: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Bucket keys of the registers (..., ROWS) of bands ``band`` (from 0)."""
    key = (band.astype(np.uint64) + _U(1)) * _U(0x9E3779B97F4A7C15) + np.zeros(banded.shape[:-1], np.uint64)
    for r in range(ROWS):
        key = mix64(key * _U(0x100000001B3) + banded[..., r])
    return key


def _band_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        key = _keys(_bands(np.frombuffer(b"".join(b.column("regs").to_pylist()), np.uint8).reshape(-1, M)), np.arange(BANDS))
        ids = np.repeat(b.column("id").to_numpy(zero_copy_only=False), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(ids)], names=["key", "id"])


def _likelihood(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of J (``at``, no larger than the sizes allow) and their joint log
    likelihood given two sketches and the set sizes."""
    over, under = np.count_nonzero(x > y, axis=1), np.count_nonzero(x < y, axis=1)
    u, v = nx / (nx + ny), ny / (nx + ny)
    J = np.minimum(at[None], np.minimum(u / v, v / u)[:, None])
    p = lambda z: np.maximum(-np.log1p(-np.maximum(z, 0) * (BASE - 1) / BASE) / np.log(BASE), 1e-12)
    up, down = p(u[:, None] - v[:, None] * J), p(v[:, None] - u[:, None] * J)
    return J, over[:, None] * np.log(up) + under[:, None] * np.log(down) + (M - over - under)[:, None] * np.log(np.maximum(1 - up - down, 1e-12))


def estimate(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood J of pairs of sketches with known set sizes."""
    J, like = _likelihood(x, y, nx, ny, np.linspace(0, 1, 101))
    return np.take_along_axis(J, like.argmax(1)[:, None], 1)[:, 0]


def likely_at(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, least: float) -> np.ndarray:
    """Whether the maximum-likelihood J is at least ``least``: the likelihood
    has one peak, so it still rises there."""
    _, like = _likelihood(x, y, nx, ny, np.array([least, least + 1e-3]))
    return like[:, 1] >= like[:, 0]


def _estimate_task(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                part = b.slice(i, 2048)
                x, y = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(-1, M) for c in ("ra", "rb"))
                nx, ny = (part.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("na", "nb"))
                keep = pa.array(likely_at(x, y, nx, ny, least))
                yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], names=["a", "b"])
    return run


def _bucket_task(least: float, percent: int):
    """Rows come sorted by (key, block, role): a block of members (role 0) is
    held, the bucket's members (role 1, of the main component, and 2) stream
    past it.  Puts out the pairs of different components that sizes and
    estimate allow, each once: in the first band the two share, and of two
    block members from the smaller one."""
    def compare(key: np.int64, role: int, held: dict, part: dict) -> tuple[np.ndarray, np.ndarray]:
        ok = (held["c"][:, None] != part["c"][None]) & (100 * np.minimum(held["n"][:, None], part["n"][None])
                                                        >= percent * np.maximum(held["n"][:, None], part["n"][None]))
        if role == 2:
            ok &= held["id"][:, None] < part["id"][None]
        i, j = np.nonzero(ok)
        out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo in range(0, len(i), 4096):
            x, y = i[lo:lo + 4096], j[lo:lo + 4096]
            good = likely_at(held["r"][x], part["r"][y], held["n"][x], part["n"][y], least)
            x, y = x[good], y[good]
            one = _bands(held["r"][x])
            first = (one == _bands(part["r"][y])).all(axis=2).argmax(axis=1)
            here = _keys(one[np.arange(len(x)), first], first).view(np.int64) == key
            out[0].append(held["id"][x[here]])
            out[1].append(part["id"][y[here]])
        x, y = (np.concatenate(o) for o in out)
        return np.minimum(x, y), np.maximum(x, y)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = None, None
        for b in batches:
            if not b.num_rows:
                continue
            key, block, role, ids, c, n = (b.column(k).to_numpy(zero_copy_only=False) for k in ("key", "block", "role", "id", "c", "n"))
            regs = np.frombuffer(b"".join(b.column("regs").to_pylist()), np.uint8).reshape(-1, M)
            cut = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1]) | (role[1:] != role[:-1])) + 1
            for lo, hi in zip(np.concatenate([[0], cut]), np.append(cut, b.num_rows), strict=True):
                part = {"id": ids[lo:hi], "c": c[lo:hi], "n": n[lo:hi].astype(float), "r": regs[lo:hi]}
                here = (key[lo], block[lo])
                if role[lo] == 0:
                    held = part if now != here else {k: np.concatenate([held[k], part[k]]) for k in part}
                    now = here
                    continue
                for i in range(0, hi - lo, 512):
                    x, y = compare(key[lo], int(role[lo]), held, {k: v[i:i + 512] for k, v in part.items()})
                    if len(x):
                        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])
    return run


def _verify_task(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = np.zeros(b.num_rows, bool)
            for i in range(0, b.num_rows, 256):  # pairs held at once
                part = b.slice(i, 256)
                sets = [[x for s in slices(part.column(c)) for x in shingle_sets(s, k)] for c in ("ta", "tb")]
                for r, (x, y) in enumerate(zip(*sets, strict=True)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok[i + r] = 100 * both >= percent * (len(x) + len(y) - both)
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])
    return run


def duplicate_classes(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``."""
    with small_batches(docs.sparkSession):
        return _classes(docs, k, percent)


def _classes(docs: DataFrame, k: int, percent: int) -> DataFrame:
    all_ = materialize(sketches(docs, k))
    some = all_.filter("doc_id is not null and n_shingles > 0")
    classes = materialize(some.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("id"), F.first("regs").alias("regs")))
    bands = classes.select("id", "regs").mapInArrow(_band_task, "key long, id long")
    shared = bands.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("other")).filter("leader < other").drop("other")
    buckets = materialize(bands.join(shared, "key"))  # rows of buckets with two classes or more
    ids = buckets.select(F.col("id").alias("doc_id")).distinct()
    texts = materialize(docs.filter("doc_id is not null").select("doc_id", "text").join(ids, "doc_id", "left_semi"))

    side = classes.select("id", "regs", F.col("n_shingles").alias("n"))
    a = side.select(F.col("id").alias("a"), F.col("regs").alias("ra"), F.col("n").alias("na"))
    b = side.select(F.col("id").alias("b"), F.col("regs").alias("rb"), F.col("n").alias("nb"))
    least = percent / 100 - SLACK * float(np.sqrt(percent / 100 * (1 - percent / 100) / M))

    def verified(likely: DataFrame) -> DataFrame:
        """Pairs (a, b) whose full sets are similar enough."""
        with_b = likely.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        both = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
        return materialize(both.select("a", "b", F.coalesce("ta", F.lit("")).alias("ta"), F.coalesce("tb", F.lit("")).alias("tb"))
                           .mapInArrow(_verify_task(k, percent), "a long, b long"))

    # each member with the leaders it shares most buckets with
    met = buckets.filter("id <> leader").groupBy("id", "leader").agg(F.count("*").alias("n"))
    best = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("n"), "leader"))
    star = met.withColumn("rank", best).filter(F.col("rank") <= LEADERS).select(F.col("leader").alias("a"), F.col("id").alias("b"))
    sized = star.join(b, "b").join(a, "a").filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    links = verified(materialize(sized.select("a", "b", "ra", "rb", "na", "nb").mapInArrow(_estimate_task(least), "a long, b long")))
    comp = materialize(components(links))

    # buckets that still hold several components: all pairs of members of different ones
    at = materialize(buckets.select("key", "id").join(comp.withColumnRenamed("component", "c"), "id", "left")
                     .select("key", "id", F.coalesce("c", "id").alias("c")))
    parts = at.groupBy("key", "c").agg(F.count("*").alias("n"))
    main = parts.groupBy("key").agg(F.max_by("c", F.struct("n", "c")).alias("main"), F.count("*").alias("kinds")).filter("kinds > 1").drop("kinds")
    mixed = at.join(main, "key")
    number = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    block = mixed.filter("c <> main").select("key", "id", "c", ((number - 1) / BLOCK).cast("int").alias("block"), F.lit(0).alias("role"))
    block = materialize(block)
    count = block.groupBy("key").agg(F.max("block").alias("last"))
    scan = (mixed.join(count, "key").select("key", "id", "c", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("block"),
                                               F.when(F.col("c") == F.col("main"), 1).otherwise(2).alias("role")))
    sides = (block.unionByName(scan).join(side, "id").repartition("key", "block").sortWithinPartitions("key", "block", "role"))
    likely = materialize(sides.select("key", "block", "role", "id", "c", "regs", "n").mapInArrow(_bucket_task(least, percent), "a long, b long"))
    more = verified(likely)
    if not more.isEmpty():
        comp = materialize(components(links.union(more)))
    root = classes.join(comp, "id", "left").select("d1", "d2", "n_shingles", F.coalesce("component", "id").alias("root"))
    return (all_.drop("regs").join(root, ["d1", "d2", "n_shingles"], "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id")))


def near_dedup(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay: of each component the one with its smallest
    doc_id, with all columns (of repeated rows of that id, one)."""
    gone = materialize(duplicate_classes(docs, k, percent).filter("component_id <> doc_id").select("doc_id").distinct())
    named = docs.filter("doc_id is not null").join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id"])
    return named.select(*docs.columns).union(docs.filter("doc_id is null"))


def op7_near_dedup(spark, sf_dir: str) -> DataFrame:
    r = duplicate_classes(read_docs(spark, sf_dir, "doc_id", "text"), 4, 80)
    return r.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
