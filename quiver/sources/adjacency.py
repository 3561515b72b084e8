"""Out-edges stored for walks: a bucketed, sorted table with a bounded row
count per node.

Walks are ordered by their hops, so the n-th out-edge of a node (by label,
target, target table) can only be on a walk that has n - 1 others before it:
the first ``limit`` walks need the first ``limit`` out-edges of each node and
no more.  Writing keeps the first ``keep`` of them with their place ``pos``, so
a hub costs a walk as much as any other node with ``keep`` edges.

The table is bucketed and sorted by ``node`` (table and id in one column):
seeds join it without an edge shuffle, and a frontier of a few nodes is a
literal filter that reads only the buckets, and in them the row groups, of
those nodes.

Layout under the root: ``edges`` (bucketed parquet) and ``meta`` (one JSON row,
written last: without it the table is not there).  A root is written once.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiver.model import MENTIONS, PropertyGraph, TripleGraph

KEEP = 1000  # also the largest k for which row_number() <= k is reduced before its shuffle
ROWS_PER_BUCKET = 1_000_000  # what a task that writes sorts at a time
_COLS = ["node", "pos", "src_table", "src", "label", "dst_table", "dst", "triplet_source_id"]
_DDL = ("node string, pos int, src_table string, src string, label string, dst_table string, dst string, "
        "triplet_source_id string")


def node_key(table, id_) -> F.Column:
    """One column that names a node: its table and id."""
    return F.concat_ws("\u0001", table, id_)


@dataclass(frozen=True)
class Adjacency:
    """An open adjacency table; ``tables`` are the tables its sources are in."""
    spark: SparkSession
    name: str
    buckets: int
    keep: int
    tables: tuple[str, ...]

    def edges(self, limit: int) -> DataFrame:
        """The first ``limit`` out-edges of each node."""
        if limit > self.keep:
            raise ValueError(f"the adjacency keeps {self.keep} edges a node: too few for a limit of {limit}")
        return self.spark.table(self.name).filter(F.col("pos") <= limit)


def graph_edges(graph: PropertyGraph) -> DataFrame:
    """Edges that walks take and whose source is a node of the graph."""
    nodes = graph.entities.select("node_table", "id").unionByName(graph.chunks.select(F.lit("Chunk").alias("node_table"), "id"))
    e = graph.edges.filter(F.col("label") != F.lit(MENTIONS))
    # a table of the nodes' keys is held, which are even; the edges stream past it unsorted
    return e.join(nodes.hint("shuffle_hash"), (F.col("src_table") == F.col("node_table")) & (F.col("src") == F.col("id")), "left_semi")


def triple_edges(tg: TripleGraph) -> DataFrame:
    return tg.links.select(F.lit("n").alias("src_table"), "src", F.col("predicate").alias("label"),
                           F.lit("n").alias("dst_table"), "dst", F.lit(None).cast("string").alias("triplet_source_id"))


def write_adjacency(edges: DataFrame, root: str, keep: int = KEEP, buckets: int | None = None) -> Adjacency:
    """Store the first ``keep`` out-edges of every node under ``root``.

    Edges without a source are left out; a NULL label sorts as an empty one.
    Edges equal in label, target and target table (parallel ones) are ordered by
    their triplet source.  The number of buckets follows the counted edges.
    """
    if keep < 1:
        raise ValueError("keep must be >= 1")
    spark = edges.sparkSession
    e = edges.filter(F.col("src").isNotNull() & F.col("src_table").isNotNull())
    if buckets is None:
        buckets = max(8, -(-e.count() // ROWS_PER_BUCKET))
    order = [F.coalesce("label", F.lit("")), F.col("dst"), F.col("dst_table"), F.col("triplet_source_id")]
    # as many tasks as buckets, however rows come in: a node's edges are dealt
    # over tasks that keep its first ones each, then meet in its bucket
    part = F.pmod(F.xxhash64("dst"), F.lit(buckets))
    e = e.withColumn("node", node_key("src_table", "src")).withColumn("_part", part)
    some = (e.repartition(buckets, "node", "_part")
            .withColumn("pos", F.row_number().over(Window.partitionBy("node", "_part").orderBy(*order)))
            .filter(F.col("pos") <= keep).drop("pos", "_part"))
    # the layout of a bucketed table is that of repartition on its column: one file a bucket
    first = (some.repartition(buckets, "node")
             .withColumn("pos", F.row_number().over(Window.partitionBy("node").orderBy(*order)))
             .filter(F.col("pos") <= keep).select(*_COLS))
    name = _table_name(root)
    (first.write.bucketBy(buckets, "node").sortBy("node", "pos")
     .option("path", _data(root)).format("parquet").saveAsTable(name))
    tables = sorted(r[0] for r in spark.table(name).select("src_table").distinct().collect())  # as many as node tables
    meta = json.dumps({"buckets": buckets, "keep": keep, "tables": tables})
    spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.text(f"{root.rstrip('/')}/meta")
    return Adjacency(spark, name, buckets, keep, tuple(tables))


def open_adjacency(spark: SparkSession, root: str) -> Adjacency:
    """Open what :func:`write_adjacency` stored, in any session."""
    meta = json.loads(spark.read.text(f"{root.rstrip('/')}/meta").first()[0])
    name = _table_name(root)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_DDL}) USING parquet CLUSTERED BY (node) SORTED BY (node, pos) "
              f"INTO {int(meta['buckets'])} BUCKETS LOCATION '{_data(root)}'")
    return Adjacency(spark, name, meta["buckets"], meta["keep"], tuple(meta["tables"]))


def _data(root: str) -> str:
    return f"{root.rstrip('/')}/edges"


def _table_name(root: str) -> str:
    return "adjacency_" + hashlib.md5(root.rstrip("/").encode()).hexdigest()
