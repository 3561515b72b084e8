"""A whole property graph built by one stream.

The stream carries change records of three kinds: chunks, entities and
relations (:data:`CHANGE_SCHEMA`, made by :func:`changes`).  They may arrive in
any order.  Chunks and entities are upserted by key, the highest ``seq`` wins.
A relation stands for one candidate edge per schema triple with its label; a
candidate whose ends are not both there yet waits, and so does the mention of a
chunk that is still to come.  Every micro-batch tries again what waits, so the
graph after the last batch is the one a single batch job would build.

Each micro-batch writes its own folders (``<table>/batch=<id>``) and then marks
itself done; readers see only done batches.  A batch replayed after a failure
rewrites folders nobody reads yet, or is skipped when it was done.  Its cost is
the batch, what waits, and one scan of the node keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiver.model import (CHUNK_SCHEMA, EDGE_SCHEMA, ENTITY_SCHEMA, GENERIC_ENTITY, GENERIC_RELATION,
                          MENTION_SCHEMA, PropertyGraph, conform, rel_table_name)
from quiver.operators.merge import EDGE_KEY, SEQ, latest_by_key, pinned, prepare_chunks, prepare_entities
from quiver.sources.snapshots import _fs
from quiver.streaming.incremental import _batches

_NODE_FIELDS = {f.name: f for s in (ENTITY_SCHEMA, CHUNK_SCHEMA) for f in s.fields if f.name != "node_table"}
CHANGE_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField(SEQ, T.LongType()),
    *[T.StructField(f.name, f.dataType) for f in _NODE_FIELDS.values()],
    T.StructField("source_id", T.StringType()), T.StructField("target_id", T.StringType()),
])
KINDS = ("chunk", "entity", "relation")
MENTION_KEY = [f.name for f in MENTION_SCHEMA.fields]


def _with_seq(schema: T.StructType) -> T.StructType:
    fields = [T.StructField(f.name, f.dataType) for f in schema.fields]
    return T.StructType(fields + [T.StructField(SEQ, T.LongType())])


# what each folder of a graph root holds
TABLES = {
    "chunks": _with_seq(CHUNK_SCHEMA), "entities": _with_seq(ENTITY_SCHEMA), "edges": _with_seq(EDGE_SCHEMA),
    "mentions": T.StructType([T.StructField(c, T.StringType()) for c in MENTION_KEY]),
    "waiting_edges": _with_seq(EDGE_SCHEMA),
    "waiting_mentions": T.StructType([T.StructField(c, T.StringType()) for c in MENTION_KEY]),
    "rejects": CHANGE_SCHEMA,
}
# key of the latest row of the tables that only grow; mentions are a set
KEYS = {"chunks": ["id"], "entities": ["node_table", "id"], "edges": EDGE_KEY, "mentions": MENTION_KEY}


def changes(kind: str, rows: DataFrame) -> DataFrame:
    """``rows`` as change records; columns a kind does not have become NULL,
    and a missing or NULL ``seq`` counts as 0."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}, got {kind!r}")
    rows = rows.withColumn("kind", F.lit(kind))
    return conform(rows, CHANGE_SCHEMA).fillna(0, [SEQ])


# ------------------------------------------------------------------- folders

def _folder(root: str, table: str, batch: int) -> str:
    return f"{root}/{table}/batch={batch:09d}"


def _read_batches(spark: SparkSession, root: str, table: str, after: int, upto: int) -> DataFrame:
    """Rows of the batches in (after, upto], pruned by folder."""
    schema = TABLES[table]
    fs, path = _fs(spark, f"{root}/{table}")
    if upto <= after or not fs.exists(path):
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])
    rows = spark.read.schema(stored).option("basePath", f"{root}/{table}").parquet(f"{root}/{table}")
    return rows.filter((F.col("batch") > after) & (F.col("batch") <= upto)).drop("batch")


def _done(spark: SparkSession, root: str) -> int:
    """The newest batch whose folders are all written (-1: none)."""
    return max(_batches(spark, f"{root}/done", "batch="), default=-1)


def _mark(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def _rows(spark: SparkSession, root: str, table: str, upto: int) -> DataFrame:
    """Stored rows up to a batch: the newest snapshot and the folders after it."""
    snap = max((s for s in _batches(spark, f"{root}/snapshots_done", "upto=") if s <= upto), default=-1)
    rows = _read_batches(spark, root, table, snap, upto)
    if snap >= 0:
        rows = rows.unionByName(spark.read.schema(TABLES[table]).parquet(f"{root}/snapshots/upto={snap:09d}/{table}"))
    return rows


def _latest(rows: DataFrame, table: str) -> DataFrame:
    return rows.distinct() if table == "mentions" else latest_by_key(rows, KEYS[table], SEQ, keep_seq=True)


# --------------------------------------------------------------- micro-batch

def candidate_edges(graph: PropertyGraph, relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One edge row per schema triple with the relation's label (generic mode:
    one, between two ``Entity`` nodes), and the relations that can never be
    an edge: a NULL end, or a label the schema does not have."""
    whole = F.col("source_id").isNotNull() & F.col("target_id").isNotNull()
    if graph.structured:
        labels = sorted({r for _, r, _ in graph.rel_schema})
        fits = whole & F.coalesce(F.col("label").isin(labels), F.lit(False))
        kinds = F.array(*[F.struct(F.lit(h).alias("src_table"), F.lit(r).alias("rel"), F.lit(t).alias("dst_table"),
                                   F.lit(rel_table_name(h, r, t)).alias("rel_table")) for h, r, t in graph.rel_schema])
        kinds = F.filter(kinds, lambda k: k["rel"] == F.col("label"))
    else:
        fits = whole
        kinds = F.array(F.struct(F.lit(GENERIC_ENTITY).alias("src_table"), F.lit(GENERIC_ENTITY).alias("dst_table"),
                                 F.lit(GENERIC_RELATION).alias("rel_table")))
    edges = relations.filter(fits).withColumn("_k", F.explode(kinds)).select(
        F.col("_k.src_table").alias("src_table"), F.col("source_id").alias("src"), F.col("_k.rel_table").alias("rel_table"),
        "label", F.col("_k.dst_table").alias("dst_table"), F.col("target_id").alias("dst"), "triplet_source_id", SEQ)
    return edges, relations.filter(~fits)


def _present(keys: DataFrame, wanted: DataFrame, cols: list[str]) -> DataFrame:
    """The wanted keys that exist, each once.  The key scan is the big side:
    wanted keys are few, so the planner may broadcast them."""
    return keys.join(wanted.select(*cols).distinct(), cols, "left_semi").distinct()


def apply_batch(graph: PropertyGraph, root: str, batch: DataFrame, batch_id: int) -> None:
    """Upsert one micro-batch into the graph stored under ``root``.

    ``graph`` gives the schema, the mode and the embedding length.  Refused
    rows go to ``rejects``.  The batch is read once a kind and once for the
    rejects, from its source."""
    spark = batch.sparkSession
    root = root.rstrip("/")
    before = _done(spark, root)
    if before >= batch_id:
        return  # replayed after it was done

    def write(table: str, rows: DataFrame) -> None:
        conform(rows, TABLES[table]).write.mode("overwrite").parquet(_folder(root, table, batch_id))

    chunks, bad_chunks = prepare_chunks(batch.filter(F.col("kind") == "chunk"), graph.embed_dim)
    entities, bad_entities = prepare_entities(graph, batch.filter(F.col("kind") == "entity"))
    # as they came: readers reduce them per key, so texts are not shuffled here
    write("chunks", chunks)
    write("entities", entities)

    edges, bad_relations = candidate_edges(graph, batch.filter(F.col("kind") == "relation"))
    # several sources of one edge stay apart here: each is a mention
    edges = (edges.unionByName(_read_batches(spark, root, "waiting_edges", before - 1, before))
             .groupBy(*EDGE_KEY, "triplet_source_id").agg(F.max(SEQ).alias(SEQ)))
    edges = pinned(edges)
    ends = edges.select(F.col("src_table").alias("t"), F.col("src").alias("i")).unionByName(
        edges.select(F.col("dst_table").alias("t"), F.col("dst").alias("i")))
    nodes = _rows(spark, root, "entities", batch_id).select(F.col("node_table").alias("t"), F.col("id").alias("i"))
    there = pinned(_present(nodes, ends, ["t", "i"]))
    for end in ("src", "dst"):
        found = there.select(F.col("t").alias(f"{end}_table"), F.col("i").alias(end), F.lit(True).alias(f"_{end}"))
        edges = edges.join(found, [f"{end}_table", end], "left")
    edges = pinned(edges)
    both = F.col("_src").isNotNull() & F.col("_dst").isNotNull()
    ready = edges.filter(both)
    write("edges", latest_by_key(ready.select(*EDGE_KEY, "triplet_source_id", SEQ), EDGE_KEY, keep_seq=True))
    write("waiting_edges", edges.filter(~both))

    named = ready.filter(F.col("triplet_source_id").isNotNull()).select(
        F.col("triplet_source_id").alias("chunk_id"), F.explode(F.array(
            F.struct(F.col("src_table").alias("t"), F.col("src").alias("i")),
            F.struct(F.col("dst_table").alias("t"), F.col("dst").alias("i")))).alias("e"))
    mentions = named.select("chunk_id", F.col("e.t").alias("entity_table"), F.col("e.i").alias("entity_id")).unionByName(
        _read_batches(spark, root, "waiting_mentions", before - 1, before)).distinct()
    mentions = pinned(mentions)
    known = _rows(spark, root, "chunks", batch_id).select(F.col("id").alias("chunk_id"))
    known = pinned(_present(known, mentions, ["chunk_id"]))
    write("mentions", mentions.join(known, "chunk_id", "left_semi"))
    write("waiting_mentions", mentions.join(known, "chunk_id", "left_anti"))

    refused = [changes("chunk", bad_chunks), changes("entity", bad_entities), changes("relation", bad_relations),
               batch.filter(~F.coalesce(F.col("kind").isin(*KINDS), F.lit(False)))]
    rejects = refused[0]
    for r in refused[1:]:
        rejects = rejects.unionByName(r)
    write("rejects", rejects)
    _mark(spark, f"{root}/done/batch={batch_id:09d}")


# --------------------------------------------------------------------- state

def current_graph(graph: PropertyGraph, root: str) -> PropertyGraph:
    """The graph of all done batches; ``graph`` gives schema and mode."""
    spark, root = graph.spark, root.rstrip("/")
    upto = _done(spark, root)
    state = {t: _latest(_rows(spark, root, t, upto), t) for t in KEYS}
    return graph.with_(chunks=conform(state["chunks"], CHUNK_SCHEMA), entities=conform(state["entities"], ENTITY_SCHEMA),
                       edges=conform(state["edges"], EDGE_SCHEMA), mentions=conform(state["mentions"], MENTION_SCHEMA))


def waiting(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Edges without both ends, and mentions without their chunk, so far."""
    root = root.rstrip("/")
    upto = _done(spark, root)
    return (_read_batches(spark, root, "waiting_edges", upto - 1, upto),
            _read_batches(spark, root, "waiting_mentions", upto - 1, upto))


def rejects(spark: SparkSession, root: str) -> DataFrame:
    """Every record refused so far."""
    root = root.rstrip("/")
    return _read_batches(spark, root, "rejects", -1, _done(spark, root))


def compact(graph: PropertyGraph, root: str) -> int:
    """Fold the done batches into one snapshot (a new folder); later batches
    and reads start from it.  Returns its batch id, -1 without a batch."""
    spark, root = graph.spark, root.rstrip("/")
    upto = _done(spark, root)
    if upto < 0 or upto in _batches(spark, f"{root}/snapshots_done", "upto="):
        return upto
    for table in KEYS:
        _latest(_rows(spark, root, table, upto), table).select(*TABLES[table].names).write.mode("overwrite").parquet(
            f"{root}/snapshots/upto={upto:09d}/{table}")
    _mark(spark, f"{root}/snapshots_done/upto={upto:09d}")
    return upto


def run_graph_stream(graph: PropertyGraph, source_dir: str, root: str, glob: str = "*.parquet",
                     max_files_per_trigger: int | None = None) -> PropertyGraph:
    """Consume all available change files and return the current graph.

    A root belongs to one stream (its checkpoint lives inside); calling again
    with the same root continues the stream."""
    root = root.rstrip("/")
    reader = graph.spark.readStream.schema(CHANGE_SCHEMA).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query = (reader.parquet(source_dir).writeStream
             .foreachBatch(lambda batch, batch_id: apply_batch(graph, root, batch, batch_id))
             .option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return current_graph(graph, root)


__all__ = ["CHANGE_SCHEMA", "changes", "candidate_edges", "apply_batch", "current_graph", "waiting", "rejects", "compact",
           "run_graph_stream"]
