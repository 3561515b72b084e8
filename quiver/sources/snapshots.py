"""Versioned parquet snapshots of a graph (open, persist, clear).

Layout under a root directory::

    v=000001/entities   partitionBy(node_table)  -> a label scan reads one folder
             chunks
             edges      partitionBy(rel_table)
             mentions
             _meta      one JSON row: relationship schema, mode, dimension

A snapshot is never overwritten: every write makes the next version, so a job
can read version N while another writes N+1.  The root must be on storage all
executors share (on a cluster: under ``spark.checkpoint.dir`` or a table path).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiver.model import (CHUNK_SCHEMA, EDGE_SCHEMA, ENTITY_SCHEMA, LINK_SCHEMA, MENTION_SCHEMA,
                          NODE_SCHEMA, PropertyGraph, TripleGraph)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, root: str) -> list[int]:
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            try:
                if fs.exists(Path(st.getPath(), "_meta/_SUCCESS")):
                    out.append(int(name[2:]))
            except ValueError:
                pass
    return sorted(out)


def _vdir(root: str, v: int) -> str:
    return f"{root.rstrip('/')}/v={v:06d}"


#: Folders a task writes at the same time; rows of further ones are sorted first.
OPEN_FOLDERS = 8
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def _write_folders(df: DataFrame, by: str, path: str) -> None:
    """One folder per value of ``by``.  A task keeps up to ``OPEN_FOLDERS`` files
    open, so it passes its rows on as they come instead of sorting them all."""
    conf = df.sparkSession.conf
    before = conf.get(_WRITERS)
    conf.set(_WRITERS, str(max(OPEN_FOLDERS, int(before))))
    try:
        df.write.mode("overwrite").partitionBy(by).parquet(path)
    finally:
        conf.set(_WRITERS, before)


def write_graph(graph: PropertyGraph, root: str, version: int | None = None) -> int:
    """Persist as the next version (or the given one, e.g. a streaming batch id,
    which makes a replayed batch rewrite the same folder)."""
    spark = graph.spark
    v = version if version is not None else (max(versions(spark, root), default=0) + 1)
    d = _vdir(root, v)
    _write_folders(graph.entities, "node_table", f"{d}/entities")
    graph.chunks.write.mode("overwrite").parquet(f"{d}/chunks")
    _write_folders(graph.edges, "rel_table", f"{d}/edges")
    graph.mentions.write.mode("overwrite").parquet(f"{d}/mentions")
    meta = {"rel_schema": [list(t) for t in graph.rel_schema], "structured": graph.structured,
            "embed_dim": graph.embed_dim, "kind": "property_graph"}
    # _meta is written last; its _SUCCESS marks the version complete
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{d}/_meta")
    return v


def read_graph(spark: SparkSession, root: str, version: int | None = None) -> PropertyGraph:
    """Open a persisted graph (latest complete version by default)."""
    vs = versions(spark, root)
    if not vs:
        raise FileNotFoundError(f"no snapshot under {root}")
    v = version if version is not None else vs[-1]
    d = _vdir(root, v)
    meta = json.loads(spark.read.text(f"{d}/_meta").first()[0])

    def rd(name, schema):
        df = spark.read.schema(schema).parquet(f"{d}/{name}")
        return df.select(*schema.fieldNames())

    return PropertyGraph(rd("entities", ENTITY_SCHEMA), rd("chunks", CHUNK_SCHEMA),
                         rd("edges", EDGE_SCHEMA), rd("mentions", MENTION_SCHEMA),
                         tuple(tuple(t) for t in meta["rel_schema"]), bool(meta["structured"]),
                         meta["embed_dim"])


def write_triples(tg: TripleGraph, root: str, version: int | None = None) -> int:
    spark = tg.nodes.sparkSession
    v = version if version is not None else (max(versions(spark, root), default=0) + 1)
    d = _vdir(root, v)
    tg.nodes.write.mode("overwrite").parquet(f"{d}/nodes")
    tg.links.write.mode("overwrite").parquet(f"{d}/links")  # predicates are free text: no folder each
    meta = {"node_table": tg.node_table, "rel_table": tg.rel_table, "kind": "triples"}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{d}/_meta")
    return v


def read_triples(spark: SparkSession, root: str, version: int | None = None) -> TripleGraph:
    """Reopen a persisted triple store (``from_persist_dir``)."""
    vs = versions(spark, root)
    if not vs:
        raise FileNotFoundError(f"no snapshot under {root}")
    d = _vdir(root, version if version is not None else vs[-1])
    meta = json.loads(spark.read.text(f"{d}/_meta").first()[0])
    nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{d}/nodes")
    links = spark.read.schema(LINK_SCHEMA).parquet(f"{d}/links").select(*LINK_SCHEMA.fieldNames())
    return TripleGraph(nodes, links, meta["node_table"], meta["rel_table"])


def graph_rows(graph: PropertyGraph):
    """Nodes and edges flattened into one (kind, a, b, c) frame, for checks."""
    n = graph.entities.select(F.lit("node").alias("kind"), F.col("node_table").alias("a"),
                              F.col("id").alias("b"), F.col("name").alias("c"))
    ch = graph.chunks.select(F.lit("chunk").alias("kind"), F.lit("Chunk").alias("a"),
                             F.col("id").alias("b"), F.col("label").alias("c"))
    e = graph.edges.select(F.lit("edge").alias("kind"), F.col("src").alias("a"),
                           F.col("label").alias("b"), F.col("dst").alias("c"))
    m = graph.mentions.select(F.lit("mention").alias("kind"), F.col("chunk_id").alias("a"),
                              F.col("entity_table").alias("b"), F.col("entity_id").alias("c"))
    return n.unionByName(ch).unionByName(e).unionByName(m)


def triple_rows(tg: TripleGraph):
    n = tg.nodes.select(F.lit("node").alias("kind"), F.col("id").alias("a"),
                        F.lit(None).cast("string").alias("b"), F.lit(None).cast("string").alias("c"))
    l = tg.links.select(F.lit("link").alias("kind"), F.col("src").alias("a"), F.col("predicate").alias("b"),
                        F.col("dst").alias("c"))
    return n.unionByName(l)
