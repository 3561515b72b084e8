"""The vector index: a two-level cell layout with radii.

Unit vectors are quantised twice: at most ``COARSE`` coarse centres, and inside
each coarse cell its own fine centres, about one for ``leaf`` vectors and at
most ``FINE`` of them.  Both levels are k-means on hash-chosen samples of a
stated size (``SAMPLE`` rows, and ``PER_CENTRE`` rows for each fine centre); every
vector is then assigned, by a matrix product with the coarse centres (a bounded
table) and, dealt by coarse cell and salt, with the fine centres of its own
coarse cell.  Coarse cells are folders, cells are sorted inside them, so a
search reads only the row groups of the cells it wants.

The table of cells keeps each cell's centre and radius (the largest angle from
the centre to a member).  Angles between unit vectors are a metric, so a cell
whose centre is ``a`` away from the query holds nothing nearer than
``a - radius``: ``search`` reads the nearest cells, then every cell whose bound
can still beat the k-th hit, and returns exactly what a full scan returns.
``probe`` reads a fixed number of cells, measured at build time to keep a wanted
recall.

``refresh`` compares (id, vector hash) with the indexed rows: new and changed
rows go to their existing cells as another segment, and rows that left or
changed are tombstoned in theirs.  Only past ``drift`` is everything rebuilt.
Every version is a new folder; nothing is overwritten.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, replace
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quiver.functions.vectors import cosine, cosine_to_literal, valid_vector
from quiver.operators.vector import TOP_K, _pack_task, _product_task, topk, topk_batch, vectors_state
from quiver.session import materialize

COARSE = 1024
FINE = 1024
#: Rows of the sample the coarse centres are fitted on, and per fine centre.
SAMPLE = 20_000
PER_CENTRE = 64
#: Rows of a coarse cell that one task assigns.
BLOCK = 10_000
#: Share of the rows that may change before the index is built anew.
DRIFT = 0.3
#: Sample queries that calibrate the number of cells to probe.
QUERIES = 100
#: Up to this many cells, their table is kept on the driver between searches
#: (versions never change); beyond, Spark searches it.
DRIVER_CELLS = 4096
#: Angles are compared with this slack (rounding of the products).
SLACK = 1e-7


#: Versions opened and their small cell tables; a version never changes.
_opened: dict[tuple[str, int], "CellIndex"] = {}
_tables: dict[tuple[str, int], dict[str, np.ndarray]] = {}


@dataclass(frozen=True)
class CellIndex:
    root: str
    version: int
    state: str
    dim: int
    segments: tuple[int, ...]
    tombstones: tuple[int, ...]
    n: int
    changed: int
    nprobe: int
    rewritten: int
    n_cells: int

    def _at(self, v: int, name: str) -> str:
        return f"{self.root}/v={v:06d}/{name}"

    def cells(self, spark: SparkSession) -> DataFrame:
        """cell, coarse, vec (unit centre), radius, n (rows ever put there)."""
        return spark.read.parquet(self._at(self.version, "cells"))

    def coarse_centres(self, spark: SparkSession) -> np.ndarray:
        """At most ``COARSE`` unit vectors."""
        rows = spark.read.parquet(self._at(self.version, "coarse")).orderBy("coarse").collect()
        return np.array([r["vec"] for r in rows])

    def rows(self, spark: SparkSession) -> DataFrame:
        """Live rows: coarse, cell, id, embedding, hash, seg."""
        parts = [spark.read.schema("cell int, id string, embedding array<double>, hash long, coarse int").parquet(self._at(s, "layout"))
                 .withColumn("seg", F.lit(s)) for s in self.segments]
        live = parts[0]
        for p in parts[1:]:
            live = live.unionByName(p)
        for t in self.tombstones:
            live = live.join(spark.read.parquet(self._at(t, "tombstones")).select("id", "seg"), ["id", "seg"], "left_anti")
        return live


# ------------------------------------------------------------------ numpy parts

def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-300)


def matrix(col) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    n = len(col)
    return col.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def spherical_kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 10) -> np.ndarray:
    """At most k unit centres of unit vectors; empty ones are dropped."""
    distinct = np.unique(x, axis=0)
    k = min(k, len(distinct))
    c = distinct[np.random.default_rng(seed).permutation(len(distinct))[:k]]
    for _ in range(rounds):
        own = nearest(x, c)[0]
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        size = np.linalg.norm(total, axis=1)
        kept = size > 1e-12
        new = total[kept] / size[kept, None]
        if new.shape == c.shape and np.allclose(new, c, atol=1e-12):
            break
        c = new
    return c


def nearest(x: np.ndarray, c: np.ndarray, step: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest centre (lowest number on ties) and the angle to it."""
    own, angle = np.zeros(len(x), np.int64), np.zeros(len(x))
    for lo in range(0, len(x), step):
        cos = x[lo:lo + step] @ c.T
        own[lo:lo + step] = cos.argmax(1)
        angle[lo:lo + step] = np.arccos(np.clip(cos.max(1), -1, 1)) if len(cos) else 0
    return own, angle


def _centres_task(k: int, seed: int):
    def run(batches):
        parts = [(b.column("id").to_pylist(), matrix(b.column("embedding"))) for b in batches if b.num_rows]
        if not parts:
            return
        order = np.argsort(np.array([i for ids, _ in parts for i in ids], object), kind="stable")
        c = spherical_kmeans(unit(np.concatenate([m for _, m in parts])[order]), k, seed)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(c)), pa.int32()), pa.array(c.tolist(), pa.list_(pa.float64()))], names=["coarse", "vec"])
    return run


def _coarse_task(sent):
    def run(batches):
        for b in batches:
            own = nearest(unit(matrix(b.column("embedding"))), sent.value)[0] if b.num_rows else []
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("id", "embedding", "hash")), pa.array(own, pa.int32())],
                                             names=["id", "embedding", "hash", "coarse"])
    return run


def _fine_centres(seed: int):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(np.array(table["id"].to_pylist(), object), kind="stable")
        coarse, k = table["coarse"][0].as_py(), table["k"][0].as_py()
        c = spherical_kmeans(unit(matrix(table["embedding"])[order]), k, seed + coarse)
        return pa.table({"coarse": pa.array([coarse] * len(c), pa.int32()),
                         "cell": pa.array([coarse * FINE + i for i in range(len(c))], pa.int32()),
                         "vec": pa.array(c.tolist(), pa.list_(pa.float64()))})
    return run


def _fine_task(rows: pa.Table, centres: pa.Table) -> pa.Table:
    centres = centres.sort_by("cell")
    own, angle = nearest(unit(matrix(rows["embedding"])), matrix(centres["vec"])) if len(rows) else ([], [])
    cell = np.array(centres["cell"].to_pylist(), np.int32)[own] if len(rows) else []
    return pa.table({"coarse": rows["coarse"], "cell": pa.array(cell, pa.int32()), "id": rows["id"], "embedding": rows["embedding"],
                     "hash": rows["hash"], "angle": pa.array(angle, pa.float64())})


def _pack_cells(batches):
    """Blocks as in ``vector``, none across cells: (cell, dim, key, m)."""
    for b in batches:
        cell = b.column("cell").to_numpy(zero_copy_only=False)
        for c in np.unique(cell):
            for block in _pack_task([b.filter(pa.array(cell == c)).select(["key", "vec"])]):
                yield pa.RecordBatch.from_arrays([pa.array([int(c)], pa.int32()), *block.columns], names=["cell", *block.schema.names])


# ------------------------------------------------------------------ building

def _valid(chunks: DataFrame, dim: int) -> DataFrame:
    """id, embedding, hash of the vectors that can be indexed."""
    v = F.col("embedding").cast("array<double>")
    return (chunks.filter(valid_vector(F.col("embedding"), dim)).select(F.col("id").cast("string").alias("id"), v.alias("embedding"))
            .withColumn("hash", F.xxhash64("embedding")))


def _assign(rows: DataFrame, centres: DataFrame, blocks: DataFrame) -> DataFrame:
    """coarse, cell, id, embedding, hash, angle of rows that know their coarse
    cell; ``blocks`` (coarse, k, salts) says how many tasks share one."""
    blocks = F.broadcast(blocks.select("coarse", "salts"))  # at most COARSE rows
    left = rows.join(blocks, "coarse").withColumn("salt", F.pmod(F.xxhash64("id"), "salts").cast("int")).drop("salts")
    right = centres.join(blocks, "coarse").select("cell", "vec", F.col("coarse").alias("c"), F.explode(F.sequence(F.lit(0), F.col("salts").cast("int") - 1)).alias("s"))
    return left.groupBy("coarse", "salt").cogroup(right.groupBy("c", "s")).applyInArrow(
        _fine_task, "coarse int, cell int, id string, embedding array<double>, hash long, angle double")


def _blocks(spark: SparkSession, rows: DataFrame, leaf: int) -> DataFrame:
    counts = [(r["coarse"], r["n"]) for r in rows.groupBy("coarse").agg(F.count("*").alias("n")).collect()]  # at most COARSE rows
    return spark.createDataFrame([(c, min(FINE, math.ceil(n / leaf)), math.ceil(n / BLOCK), n) for c, n in counts],
                                 "coarse int, k int, salts long, n long")


def _write_layout(assigned: DataFrame, path: str) -> None:
    (assigned.drop("angle").repartition("coarse", F.expr("cell div 64")).sortWithinPartitions("coarse", "cell")
     .write.partitionBy("coarse").parquet(path))


def _versions(spark: SparkSession, root: str) -> list[int]:
    from quiver.sources.snapshots import versions
    return versions(spark, root)


def _finish(spark: SparkSession, index: CellIndex) -> CellIndex:
    """The meta file comes last: its marker makes the version visible."""
    meta = {k: v for k, v in asdict(index).items() if k not in ("root", "version")}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.text(index._at(index.version, "_meta"))
    return index


def _next(spark: SparkSession, root: str) -> int:
    """A folder number no earlier attempt, complete or not, has used."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return max([int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit()], default=0) + 1


def build(chunks: DataFrame, root: str, dim: int, state: str | None = None, leaf: int | None = None, seed: int = 42,
          target: float = 0.98, k: int = TOP_K) -> CellIndex | None:
    """A new version indexing ``chunks`` as they are; None without vectors.

    ``leaf`` rows are wanted in a cell (the square root of the rows, from 16 to
    1,000, unless given).  ``target`` is the recall of the k nearest that the
    index's ``nprobe`` cells keep on ``QUERIES`` hash-chosen rows."""
    spark, root = chunks.sparkSession, root.rstrip("/")
    base = materialize(_valid(chunks, dim))
    n = base.count()
    if n == 0:
        return None
    leaf = leaf or int(min(1000, max(16, math.sqrt(n))))
    n_coarse = min(COARSE, max(1, round(math.sqrt(n / leaf))))
    chosen = lambda share, size: F.pmod(F.xxhash64(F.lit(seed), F.col("id")), share) < size
    coarse = (base.filter(chosen(F.lit(n), F.lit(SAMPLE))).select("id", "embedding").coalesce(1)
              .mapInArrow(_centres_task(n_coarse, seed), "coarse int, vec array<double>").collect())
    centres = np.array([r["vec"] for r in sorted(coarse, key=lambda r: r["coarse"])])
    if not len(centres):  # the sample missed every row of a tiny table
        centres = unit(np.array([base.first()["embedding"]]))
    version = _next(spark, root)
    index = CellIndex(root, version, state if state is not None else vectors_state(chunks, dim), dim, (version,), (), n, 0, 1, n, 0)
    spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "coarse int, vec array<double>").coalesce(1).write.parquet(index._at(version, "coarse"))
    rows = materialize(base.mapInArrow(_coarse_task(spark.sparkContext.broadcast(centres)), "id string, embedding array<double>, hash long, coarse int"))
    blocks = _blocks(spark, rows, leaf)
    sample = rows.join(F.broadcast(blocks), "coarse").filter(chosen(F.col("n"), F.col("k") * PER_CENTRE))
    fine = sample.groupBy("coarse").applyInArrow(_fine_centres(seed), "coarse int, cell int, vec array<double>")
    lone = spark.createDataFrame([(i, i * FINE, c.tolist()) for i, c in enumerate(centres)], "coarse int, cell int, vec array<double>")
    fine = materialize(fine)
    fine = fine.unionByName(lone.join(fine, "coarse", "left_anti"))  # coarse cells the sample missed
    assigned = materialize(_assign(rows, fine, blocks))
    _write_layout(assigned, index._at(version, "layout"))
    stats = assigned.groupBy("cell").agg(F.max("angle").alias("radius"), F.count("*").alias("n"))
    fine.join(stats, "cell").select("cell", "coarse", "vec", "radius", "n").write.parquet(index._at(version, "cells"))
    index = replace(index, n_cells=index.cells(spark).count(), nprobe=_calibrate(spark, index, assigned, n, target, k, seed))
    return _finish(spark, index)


def _calibrate(spark: SparkSession, index: CellIndex, assigned: DataFrame, n: int, target: float, k: int, seed: int) -> int:
    """How many nearest cells hold ``target`` of the true k neighbours of the
    sample queries (one blocked product over the rows)."""
    q = assigned.filter(F.pmod(F.xxhash64(F.lit(seed + 1), F.col("id")), F.lit(n)) < QUERIES).select(F.col("id").alias("qid"), F.col("embedding").alias("vec"))
    q = materialize(q)
    hits = topk_batch(assigned.select("id", "embedding"), q, k, index.dim).select("qid", "id").join(assigned.select("id", "cell"), "id")
    order = Window.partitionBy("qid").orderBy(F.desc("similarity"), "cell")
    cells = index.cells(spark).select(F.col("cell").alias("id"), F.col("vec").alias("embedding"))
    ranks = (topk_batch(cells, q, COARSE * FINE, index.dim).select("qid", F.col("id").alias("cell"), "similarity")
             .withColumn("r", F.row_number().over(order)))
    found = hits.join(ranks, ["qid", "cell"]).groupBy("r").agg(F.count("*").alias("n")).orderBy("r").collect()
    total, seen = sum(r["n"] for r in found), 0
    for r in found:
        seen += r["n"]
        if seen >= target * total:
            return int(r["r"])
    return 1


def open_index(spark: SparkSession, root: str, version: int | None = None) -> CellIndex:
    root = root.rstrip("/")
    have = _versions(spark, root)
    if not have:
        raise FileNotFoundError(f"no vector index under {root}")
    v = version if version is not None else have[-1]
    if (root, v) not in _opened:
        meta = json.loads(spark.read.text(f"{root}/v={v:06d}/_meta").first()[0])
        _opened[root, v] = CellIndex(root, v, **{**meta, "segments": tuple(meta["segments"]), "tombstones": tuple(meta["tombstones"])})
    return _opened[root, v]


def refresh(index: CellIndex, chunks: DataFrame, state: str | None = None, drift: float = DRIFT) -> CellIndex | None:
    """The index of ``chunks`` as they are now, from an earlier version."""
    spark = chunks.sparkSession
    now = materialize(_valid(chunks, index.dim))
    have = index.rows(spark).select("id", "hash", "seg")
    fresh = materialize(now.join(have, ["id", "hash"], "left_anti"))
    gone = materialize(have.join(now.select("id", "hash"), ["id", "hash"], "left_anti").select("id", "seg"))
    n_fresh, n_gone = fresh.count(), gone.count()
    n, changed = index.n + n_fresh - n_gone, index.changed + n_fresh + n_gone
    if n == 0:
        return None
    if changed > drift * index.n:
        return build(chunks, index.root, index.dim, state)
    v = _next(spark, index.root)
    out = CellIndex(index.root, v, state if state is not None else vectors_state(chunks, index.dim), index.dim,
                    index.segments + ((v,) if n_fresh else ()), index.tombstones + ((v,) if n_gone else ()), n, changed, index.nprobe, n_fresh, index.n_cells)
    spark.read.parquet(index._at(index.version, "coarse")).coalesce(1).write.parquet(out._at(v, "coarse"))
    cells = index.cells(spark)
    if n_fresh:
        rows = fresh.mapInArrow(_coarse_task(spark.sparkContext.broadcast(index.coarse_centres(spark))),
                                "id string, embedding array<double>, hash long, coarse int")
        rows = materialize(rows)
        assigned = materialize(_assign(rows, cells.select("coarse", "cell", "vec"), _blocks(spark, rows, 1000)))
        _write_layout(assigned, out._at(v, "layout"))
        new = assigned.groupBy("cell").agg(F.max("angle").alias("_r"), F.count("*").alias("_n"))
        cells = cells.join(new, "cell", "left").select("cell", "coarse", "vec", F.greatest("radius", "_r").alias("radius"),
                                                       (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n"))
    cells.write.parquet(out._at(v, "cells"))
    if n_gone:
        gone.write.parquet(out._at(v, "tombstones"))
    return _finish(spark, out)


def ensure(chunks: DataFrame, root: str, dim: int, state: str | None = None) -> CellIndex | None:
    """The index of ``chunks`` as they are now: the stored one if its state is
    the same, else a refreshed one, else a first build."""
    spark = chunks.sparkSession
    state = state if state is not None else vectors_state(chunks, dim)
    if not _versions(spark, root):
        return build(chunks, root, dim, state)
    index = open_index(spark, root)
    return index if index.state == state else refresh(index, chunks, state)


# ------------------------------------------------------------------ searching

def bounds(index: CellIndex, spark: SparkSession, query: Sequence[float]) -> DataFrame:
    """cell, coarse, angle of its centre to the query, and the least angle a
    member can have."""
    cos = F.least(F.greatest(cosine_to_literal(F.col("vec"), query), F.lit(-1.0)), F.lit(1.0))
    return index.cells(spark).select("cell", "coarse", "n", "radius", F.acos(cos).alias("angle")).withColumn(
        "least", F.greatest(F.col("angle") - F.col("radius"), F.lit(0.0)))


def _bounds_here(index: CellIndex, spark: SparkSession, query: Sequence[float]) -> dict[str, np.ndarray] | None:
    """:func:`bounds` as arrays on the driver, for an index of few cells."""
    if index.n_cells > DRIVER_CELLS:
        return None
    at = (index.root, index.version)
    if at not in _tables:
        rows = index.cells(spark).orderBy("cell").collect()
        _tables[at] = {"cell": np.array([r["cell"] for r in rows]), "coarse": np.array([r["coarse"] for r in rows]),
                       "vec": np.array([r["vec"] for r in rows]), "radius": np.array([r["radius"] for r in rows]), "n": np.array([r["n"] for r in rows])}
    t = _tables[at]
    angle = np.arccos(np.clip(t["vec"] @ unit(np.asarray(query, np.float64)), -1, 1))
    return {**t, "angle": angle, "least": np.maximum(angle - t["radius"], 0)}


def _in_cells(rows: DataFrame, cell: Sequence[int], coarse: Sequence[int]) -> DataFrame:
    return rows.filter(F.col("coarse").isin(sorted({int(c) for c in coarse})) & F.col("cell").isin([int(c) for c in cell]))


def probe(spark: SparkSession, index: CellIndex, query: Sequence[float], k: int = TOP_K, nprobe: int | None = None) -> DataFrame:
    """Approximate top-k: id, similarity, rank over the ``nprobe`` cells whose
    centres are nearest."""
    nprobe, b = nprobe or index.nprobe, _bounds_here(index, spark, query)
    if b is not None:
        near = np.lexsort((b["cell"], b["angle"]))[:nprobe]
        rows = _in_cells(index.rows(spark), b["cell"][near], b["coarse"][near])
    else:
        near = bounds(index, spark, query).orderBy("angle", "cell").limit(nprobe).select("cell", "coarse").collect()
        rows = _in_cells(index.rows(spark), [r["cell"] for r in near], [r["coarse"] for r in near])
    return topk(rows, query, k, index.dim, cols=("id",))


def _reach(spark: SparkSession, index: CellIndex, query: Sequence[float], k: int, first: int) -> float:
    """The k-th angle found in the ``first`` nearest cells: no cell whose bound
    exceeds it can hold one of the k nearest."""
    found = probe(spark, index, query, k, first).agg(F.count("*").alias("n"), F.min("similarity").alias("s")).first()
    return (math.acos(max(-1.0, min(1.0, found["s"]))) if found["n"] >= k else math.pi) + SLACK


def search_counted(spark: SparkSession, index: CellIndex, query: Sequence[float], k: int = TOP_K,
                   first: int = 4) -> tuple[DataFrame, dict[str, int]]:
    """Exact top-k (id, similarity, rank), reading only reachable cells, and
    how many cells and rows these are (``cells``, ``rows``) of how many."""
    reach, b, rows = _reach(spark, index, query, k, first), _bounds_here(index, spark, query), index.rows(spark)
    if b is None:
        read = F.col("least") <= F.lit(reach)
        cells = bounds(index, spark, query)
        n = cells.agg(F.count_if(read).alias("cells"), F.coalesce(F.sum(F.when(read, F.col("n"))), F.lit(0)).alias("rows"),
                      F.count("*").alias("all_cells"), F.sum("n").alias("all_rows")).first().asDict()
        # at most COARSE * FINE pairs of ints
        rows = rows.join(F.broadcast(cells.filter(read).select("coarse", "cell")), ["coarse", "cell"], "left_semi")
    else:
        read = b["least"] <= reach
        n = {"cells": int(read.sum()), "rows": int(b["n"][read].sum()), "all_cells": len(read), "all_rows": int(b["n"].sum())}
        if not read.all():
            rows = _in_cells(rows, b["cell"][read], b["coarse"][read])
    return topk(rows, query, k, index.dim, cols=("id",)), n


def search(spark: SparkSession, index: CellIndex, query: Sequence[float], k: int = TOP_K, first: int = 4) -> DataFrame:
    """Exact top-k: id, similarity, rank."""
    return search_counted(spark, index, query, k, first)[0]


def probe_batch(spark: SparkSession, index: CellIndex, queries: DataFrame, k: int = TOP_K, nprobe: int | None = None) -> DataFrame:
    """Approximate top-k of a frame of queries (qid, vec): each meets the rows
    of its nearest cells only.

    Rows and queries are packed into blocks that stay inside a cell; a block of
    rows meets the blocks of its cell's queries in one matrix product, and the k
    best of each query and block go on, not the pairs."""
    q = queries.select("qid", F.col("vec").cast("array<double>").alias("vec"))
    cells = index.cells(spark).select(F.col("cell").alias("id"), F.col("vec").alias("embedding"))
    near = topk_batch(cells, q, nprobe or index.nprobe, index.dim).select("qid", F.col("id").alias("cell")).join(q, "qid")
    key = queries.schema["qid"].dataType
    packed = lambda df, t: df.mapInArrow(_pack_cells, f"cell int, dim int, key array<{t}>, m binary")
    asked = near.select("cell", F.col("qid").alias("key"), "vec").repartition("cell").sortWithinPartitions("cell")
    # written once, so the planner knows the size of the queries' side
    blocks = (materialize(packed(asked, key.simpleString()).withColumn("block", F.monotonically_increasing_id()))
              .select("cell", F.col("dim").alias("qdim"), F.col("key").alias("qkey"), F.col("m").alias("qm"), "block"))
    rows = packed(index.rows(spark).select("cell", F.col("id").alias("key"), F.col("embedding").alias("vec")), "string")
    scored = rows.join(blocks, "cell").drop("cell").mapInArrow(
        _product_task(k, pa.string(), to_arrow_type(key)), f"qid {key.simpleString()}, id string, similarity double")
    w = Window.partitionBy("qid").orderBy(F.desc("similarity"), "id")
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def misplaced(index: CellIndex, spark: SparkSession) -> DataFrame:
    """Live rows outside their cell's radius, or with a nearer centre in their
    coarse cell (cells of one coarse cell are joined to its rows)."""
    cells = index.cells(spark).select("coarse", F.col("cell").alias("other"), "vec", "radius")
    cos = F.least(F.col("embedding_cos"), F.lit(1.0))
    near = index.rows(spark).join(cells, "coarse").withColumn("embedding_cos", cosine(F.col("embedding"), F.col("vec")))
    per = near.groupBy("id").agg(F.max("embedding_cos").alias("best"), F.max(F.when(F.col("other") == F.col("cell"), F.col("embedding_cos"))).alias("own"),
                                 F.max(F.when(F.col("other") == F.col("cell"), F.acos(cos) - F.col("radius"))).alias("over"))
    return per.filter("own IS NULL OR own < best - 1e-9 OR over > 1e-6").select("id")
