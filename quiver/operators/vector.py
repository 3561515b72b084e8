"""Cosine top-k over chunk embeddings: exact, and for many queries at once
(the index is in ``cells``).

Exact search is one scan: the query vector is a literal (|q| folded on the
driver), similarity is a JVM-side higher-order-function expression, and
``orderBy(...).limit(k)`` runs as TakeOrderedAndProject (a k-row heap per task).
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quiver.functions.vectors import cosine, cosine_to_literal, valid_vector
from quiver.session import materialize

TOP_K = 5


def centroids_by(df: DataFrame, group_col: str, vec_col: str = "embedding", dim: int | None = None) -> DataFrame:
    """Mean vector per group: (group, vec).

    With a known dimension this is one vector aggregate (partial aggregation
    map-side, one small shuffle, no row explosion); vectors of another length
    are left out.  Without one, vectors are exploded per dimension and
    averaged."""
    v = F.col(vec_col).cast("array<double>")
    if dim is not None:
        from pyspark.ml.functions import array_to_vector, vector_to_array
        from pyspark.ml.stat import Summarizer
        ok = df.filter(F.col(vec_col).isNotNull() & (F.size(vec_col) == F.lit(dim)))
        mean = ok.select(group_col, array_to_vector(v).alias("_v")).groupBy(group_col).agg(Summarizer.mean(F.col("_v")).alias("_m"))
        return mean.select(group_col, vector_to_array("_m").alias("vec"))
    e = df.filter(F.col(vec_col).isNotNull()).select(group_col, F.posexplode(v).alias("pos", "x"))
    per_dim = e.groupBy(group_col, "pos").agg(F.avg("x").alias("x"))
    return per_dim.groupBy(group_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("vec"))


def topk(chunks: DataFrame, query: Sequence[float], k: int = TOP_K, dim: int | None = None,
         cols: Sequence[str] = ("id", "text")) -> DataFrame:
    """Exact cosine top-k; NULL, empty, wrong-length and zero vectors are skipped.
    Ranked on the unrounded similarity with id as the tie-break."""
    scored = (chunks.filter(valid_vector(F.col("embedding"), dim or len(query)))
              .select(*cols, cosine_to_literal(F.col("embedding"), query).alias("similarity")))
    return (scored.orderBy(F.desc("similarity"), F.asc("id")).limit(k)
            .withColumn("rank", F.row_number().over(Window.orderBy(F.desc("similarity"), F.asc("id")))))


#: Vectors of one block of the blocked product, on either side.
BLOCK_ROWS = 2048
#: Best rows a task holds before it passes them on.
HELD_ROWS = 1 << 20


def _pack_task(batches):
    """Blocks of at most ``BLOCK_ROWS`` vectors of one length: (dim, key, m)."""
    for b in batches:
        key, vec = b.column("key"), b.column("vec")
        size = pc.list_value_length(vec).to_numpy(zero_copy_only=False)
        for d in np.unique(size):
            at = np.flatnonzero(size == d)
            for lo in range(0, len(at), BLOCK_ROWS):
                take = pa.array(at[lo:lo + BLOCK_ROWS])
                m = pc.take(vec, take).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(d)], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(take)], pa.int32()), pc.take(key, take)),
                     pa.array([m.tobytes()], pa.binary())], names=["dim", "key", "m"])


def _best_of(row: np.ndarray, id_: np.ndarray, sim: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each row: most similar, then smallest id."""
    order = np.lexsort((id_, -sim, row))
    first = np.searchsorted(row[order], row[order])
    return order[np.arange(len(order)) - first < k]


def _product_task(k: int, id_type: pa.DataType, key_type: pa.DataType):
    def run(batches):
        held, rows = {}, 0  # query block -> (its keys, row, id, similarity)

        def out():
            for keys, row, id_, sim in held.values():
                yield pa.RecordBatch.from_arrays([pc.take(keys, pa.array(row)).cast(key_type), pa.array(id_.tolist(), id_type), pa.array(sim)],
                                                 names=["qid", "id", "similarity"])

        for b in batches:
            for i in range(b.num_rows):
                d = b.column("dim")[i].as_py()
                if d != b.column("qdim")[i].as_py():
                    continue
                a = np.frombuffer(b.column("m")[i].as_buffer(), np.float64).reshape(-1, d)
                q = np.frombuffer(b.column("qm")[i].as_buffer(), np.float64).reshape(-1, d)
                na, nq = np.sqrt(np.einsum("ij,ij->i", a, a)), np.sqrt(np.einsum("ij,ij->i", q, q))
                s = (q / nq[:, None]) @ (a / na[:, None]).T
                if s.shape[1] > k:  # rounding of the product may differ between equal vectors
                    s_k = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
                    row, col = np.nonzero(s >= s_k[:, None] - 1e-9)
                else:
                    row, col = (x.ravel() for x in np.indices(s.shape))
                sim = np.einsum("ij,ij->i", a[col], q[row]) / (na[col] * nq[row])
                id_ = np.array(b.column("key")[i].values.to_pylist())[col]
                block = b.column("block")[i].as_py()
                if block in held:
                    _, r0, i0, s0 = held[block]
                    row, id_, sim = np.concatenate([r0, row]), np.concatenate([i0, id_]), np.concatenate([s0, sim])
                    rows -= len(r0)
                best = _best_of(row, id_, sim, k)
                held[block] = (b.column("qkey")[i].values, row[best], id_[best], sim[best])
                rows += len(best)
                if rows > HELD_ROWS:
                    yield from out()
                    held, rows = {}, 0
        yield from out()
    return run


def topk_batch(chunks: DataFrame, queries: DataFrame, k: int = TOP_K, dim: int | None = None) -> DataFrame:
    """Top-k (qid, id, similarity, rank) for each query (qid, vec) of a frame
    of any length.

    Both sides are packed into blocks of at most ``BLOCK_ROWS`` vectors, block
    meets block, and one matrix product gives a pair's similarities.  A task
    keeps the k best rows of each query over all the blocks it sees and passes
    on those, not the pairs; the ``row_number() <= k`` filter over them becomes
    a WindowGroupLimit.  Ties go to the smallest id.
    """
    id_type, key_type = chunks.schema["id"].dataType, queries.schema["qid"].dataType
    base = chunks.filter(valid_vector(F.col("embedding"), dim)).select(F.col("id").alias("key"), F.col("embedding").cast("array<double>").alias("vec"))
    q = queries.select(F.col("qid").alias("key"), F.col("vec").cast("array<double>").alias("vec")).filter(valid_vector(F.col("vec"), dim))
    packed = lambda df, t: df.mapInArrow(_pack_task, f"dim int, key array<{t.simpleString()}>, m binary")
    # written once, so the planner knows the size of the queries' side
    blocks = (materialize(packed(q, key_type).withColumn("block", F.monotonically_increasing_id()))
              .select(F.col("dim").alias("qdim"), F.col("key").alias("qkey"), F.col("m").alias("qm"), "block"))
    pairs = packed(base, id_type).crossJoin(blocks)
    best = pairs.mapInArrow(_product_task(k, to_arrow_type(id_type), to_arrow_type(key_type)),
                            f"qid {key_type.simpleString()}, id {id_type.simpleString()}, similarity double")
    w = Window.partitionBy("qid").orderBy(F.desc("similarity"), F.asc("id"))
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def similarity_to_group_centroid(chunks: DataFrame, centroids: DataFrame, group_col: str) -> DataFrame:
    """Each chunk's cosine to its own group's centroid (equi-join on the group)."""
    return (chunks.filter(valid_vector(F.col("embedding"), None)).join(centroids, group_col)
            .select("id", group_col, cosine(F.col("embedding"), F.col("vec")).alias("similarity")))


def embedding_dims(chunks: DataFrame) -> DataFrame:
    """How many chunks have each embedding length (NULL = no embedding)."""
    return (chunks.select(F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("dims"))
            .groupBy("dims").agg(F.count(F.lit(1)).alias("n")))


def choose_dimension(chunks: DataFrame, given: int | None = None) -> int | None:
    """The dimension to work with: what the stored vectors have (the smallest
    of the most frequent lengths), else ``given``, else unknown."""
    found = (embedding_dims(chunks).filter("dims > 0").orderBy(F.desc("n"), "dims").limit(1).collect())
    return int(found[0]["dims"]) if found else given


def vectors_state(chunks: DataFrame, dim: int | None = None) -> str:
    """Count and checksum of the valid vectors: changes when any row does."""
    r = (chunks.filter(valid_vector(F.col("embedding"), dim))
         .agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("id", "embedding").cast("decimal(38,0)")).alias("h")).collect()[0])
    return f"{r['n']}:{r['h']}"


def recall(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """recall@k per query and overall: |approx ∩ exact| / |exact|."""
    hit = exact.select("qid", "id").join(approx.select("qid", "id", F.lit(1).alias("h")), ["qid", "id"], "left")
    return hit.agg(F.count(F.lit(1)).alias("n_exact"), F.sum(F.coalesce("h", F.lit(0))).alias("n_found"),
                   (F.sum(F.coalesce("h", F.lit(0))) / F.count(F.lit(1))).alias("recall"))
