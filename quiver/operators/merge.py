"""Upsert and cascading delete as set operations.

Spark has no MERGE INTO for plain parquet, so an upsert is
``existing ANTI JOIN batch_keys  UNION  latest(batch)``: one shuffle on the key
(or none, when AQE sees a small batch and broadcasts it).  "Last write wins"
needs an explicit ``seq`` column; the batch is reduced to one row per key with
``max_by`` which aggregates map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.functions.text import strip, to_date_or_null
from quiver.session import materialize
from quiver.model import (CHUNK_SCHEMA, CHUNK_TABLE, EDGE_SCHEMA, ENTITY_SCHEMA,
                          GENERIC_ENTITY, GENERIC_RELATION, LINK_SCHEMA, MENTION_SCHEMA,
                          PropertyGraph, TripleGraph, conform, rel_table_name)
from quiver.operators.keys import Keys, all_true, key_frame

SEQ = "seq"


def pinned(df: DataFrame) -> DataFrame:
    """Materialise a frame that several branches of one plan read (a batch,
    its resolution, a victim set).  Without it Catalyst pushes joins into
    every union branch of the graph and each copy recomputes the batch.  A
    reliable checkpoint in the shared folder: it survives executor loss."""
    return materialize(df)


def latest_by_key(batch: DataFrame, keys: list[str], seq: str = SEQ, keep_seq: bool = False) -> DataFrame:
    """One row per key: the one with the highest ``seq`` (ties broken on all
    other columns, so the result never depends on task order)."""
    other = [c for c in batch.columns if c not in keys and c != seq]
    vals = other + ([seq] if keep_seq else [])
    if not vals:
        return batch.select(*keys).distinct()
    order = F.struct(F.col(seq), *[F.col(c) for c in other])
    return (batch.groupBy(*keys)
            .agg(F.max_by(F.struct(*[F.col(c) for c in vals]), order).alias("_v"))
            .select(*keys, "_v.*"))


def merge_rows(existing: DataFrame, batch: DataFrame, keys: list[str], seq: str = SEQ) -> DataFrame:
    """Full-row replace by key (NULLs overwrite too)."""
    latest = pinned(latest_by_key(batch, keys, seq))
    kept = existing.join(latest.select(*keys), keys, "left_anti")
    return kept.unionByName(latest.select(*existing.columns))


def _dates(df: DataFrame, cols: tuple[str, ...] = ("creation_date", "last_modified_date")) -> DataFrame:
    for c in cols:
        if c in df.columns and dict(df.dtypes)[c] != "date":
            df = df.withColumn(c, to_date_or_null(F.col(c)))
    return df


# ------------------------------------------------------------------ chunks

def prepare_chunks(batch: DataFrame, embed_dim: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Normalise a chunk batch: strip text, parse dates, check embedding length.

    Returns (accepted, rejects).  A row without id is a reject, and so is a
    wrong-length embedding when the graph has a fixed dimension; a NULL
    embedding is allowed.
    """
    df = batch
    if "text" in df.columns:
        df = df.withColumn("text", strip(F.col("text")))
    if "embedding" in df.columns:
        df = df.withColumn("embedding", F.col("embedding").cast("array<double>"))
    df = _dates(df)
    if SEQ not in df.columns:
        df = df.withColumn(SEQ, F.lit(0))
    full = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in CHUNK_SCHEMA.fields], F.col(SEQ))
    bad = F.col("id").isNull()
    if embed_dim is not None:
        bad = bad | (F.col("embedding").isNotNull() & (F.size("embedding") != F.lit(embed_dim)))
    return full.filter(~bad), full.filter(bad)


def upsert_chunks(graph: PropertyGraph, batch: DataFrame) -> tuple[PropertyGraph, DataFrame]:
    """The graph after the upsert, and the batch rows that were rejected."""
    accepted, rejects = prepare_chunks(batch, graph.embed_dim)
    return graph.with_(chunks=merge_rows(graph.chunks, accepted, ["id"])), rejects


# ---------------------------------------------------------------- entities

def entity_tables(graph: PropertyGraph) -> list[str]:
    return [t for t in graph.entity_types() if t != CHUNK_TABLE]


def route_entities(graph: PropertyGraph, batch: DataFrame) -> DataFrame:
    """Add ``node_table``: the label when it names an entity table, else the
    generic ``Entity`` table (strict mode: NULL, i.e. rejected)."""
    tables = entity_tables(graph)
    known = F.coalesce(F.col("label").isin(tables), F.lit(False))
    fallback = F.lit(None).cast("string") if graph.structured and GENERIC_ENTITY not in tables \
        else F.lit(GENERIC_ENTITY)
    df = batch
    if "id" not in df.columns:
        df = df.withColumn("id", F.col("name"))
    else:
        df = df.withColumn("id", F.coalesce(F.col("id"), F.col("name")))
    return df.withColumn("node_table", F.when(known, F.col("label")).otherwise(fallback))


def prepare_entities(graph: PropertyGraph, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    df = _dates(route_entities(graph, batch))
    if SEQ not in df.columns:
        df = df.withColumn(SEQ, F.lit(0))
    full = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in ENTITY_SCHEMA.fields], F.col(SEQ))
    ok = F.col("node_table").isNotNull() & F.col("id").isNotNull()
    return full.filter(ok), full.filter(~ok)


def upsert_entities(graph: PropertyGraph, batch: DataFrame) -> tuple[PropertyGraph, DataFrame]:
    """The graph after the upsert, and the batch rows that were rejected."""
    accepted, rejects = prepare_entities(graph, batch)
    return graph.with_(entities=merge_rows(graph.entities, accepted, ["node_table", "id"])), rejects


def upsert_nodes(graph: PropertyGraph, batch: DataFrame, kind: str = "kind") -> tuple[PropertyGraph, DataFrame]:
    """A mixed batch: rows whose ``kind`` is ``chunk`` go to the chunk table,
    ``entity`` to the entity tables, others nowhere.  Returns the graph and
    the rejects of both branches (kind, id)."""
    batch = pinned(batch)
    g, bad_chunks = upsert_chunks(graph, batch.filter(F.col(kind) == "chunk").drop(kind))
    g, bad_entities = upsert_entities(g, batch.filter(F.col(kind) == "entity").drop(kind))
    rejects = (bad_chunks.select(F.lit("chunk").alias("kind"), "id")
               .unionByName(bad_entities.select(F.lit("entity").alias("kind"), "id")))
    return g, rejects


# ------------------------------------------------------------------- edges

def resolve_relations(graph: PropertyGraph, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Give each relation (label, source_id, target_id, triplet_source_id, seq)
    its endpoint tables and edge table.

    Both endpoints must exist and the (head, label, tail) triple must be in the
    schema (generic mode: both endpoints in ``Entity``, table ``LINKS``).
    Returns (resolved edges with seq, rejected relations).
    """
    rel = batch
    if "triplet_source_id" not in rel.columns:
        rel = rel.withColumn("triplet_source_id", F.lit(None).cast("string"))
    if SEQ not in rel.columns:
        rel = rel.withColumn(SEQ, F.lit(0))
    rel = rel.select("label", "source_id", "target_id", "triplet_source_id", SEQ)
    ents = graph.entities.select("node_table", "id")
    cand = (rel.join(ents.select(F.col("node_table").alias("src_table"), F.col("id").alias("source_id")),
                     "source_id")
               .join(ents.select(F.col("node_table").alias("dst_table"), F.col("id").alias("target_id")),
                     "target_id"))
    if graph.structured:
        schema = [(h, r, t, rel_table_name(h, r, t)) for h, r, t in graph.rel_schema]
        sdf = F.broadcast(graph.spark.createDataFrame(
            schema, "src_table string, label string, dst_table string, rel_table string"))
        ok = cand.join(sdf, ["src_table", "label", "dst_table"])
    else:
        ok = cand.filter((F.col("src_table") == GENERIC_ENTITY) & (F.col("dst_table") == GENERIC_ENTITY)) \
                 .withColumn("rel_table", F.lit(GENERIC_RELATION))
    resolved = ok.select("src_table", F.col("source_id").alias("src"), "rel_table", "label",
                         "dst_table", F.col("target_id").alias("dst"), "triplet_source_id", SEQ)
    keys = ["label", "source_id", "target_id", SEQ]
    rejects = rel.join(ok.select(*keys), [rel[k].eqNullSafe(ok[k]) for k in keys], "left_anti")
    return resolved, rejects


EDGE_KEY = ["src_table", "src", "rel_table", "label", "dst_table", "dst"]


def merge_edges(graph: PropertyGraph, resolved: DataFrame) -> PropertyGraph:
    """MERGE on (endpoints, edge table, label); ``triplet_source_id`` is SET
    from the latest relation for that key."""
    return graph.with_(edges=merge_rows(graph.edges, resolved, EDGE_KEY))


def upsert_edges(graph: PropertyGraph, batch: DataFrame) -> tuple[PropertyGraph, DataFrame]:
    """The graph after the upsert, and the relations that were rejected."""
    resolved, rejects = resolve_relations(graph, batch)
    return merge_edges(graph, resolved), rejects


def mentions_for(graph: PropertyGraph, resolved: DataFrame) -> DataFrame:
    """MENTIONS rows implied by resolved relations whose source chunk exists."""
    chunks = graph.chunks.select(F.col("id").alias("triplet_source_id"))
    hit = resolved.join(chunks, "triplet_source_id", "left_semi")
    ends = hit.select("triplet_source_id", F.explode(F.array(
        F.struct(F.col("src_table").alias("t"), F.col("src").alias("i")),
        F.struct(F.col("dst_table").alias("t"), F.col("dst").alias("i")))).alias("e"))
    return ends.select(F.col("triplet_source_id").alias("chunk_id"),
                       F.col("e.t").alias("entity_table"), F.col("e.i").alias("entity_id"))


def link_mentions(graph: PropertyGraph, batch: DataFrame, resolved: DataFrame | None = None) -> PropertyGraph:
    """Add chunk -> entity MENTIONS for the batch's relations (set semantics)."""
    if resolved is None:
        resolved, _ = resolve_relations(graph, batch)
    new = mentions_for(graph, resolved).distinct()
    fresh = new.join(graph.mentions, ["chunk_id", "entity_table", "entity_id"], "left_anti")
    return graph.with_(mentions=graph.mentions.unionByName(fresh))


def upsert_relations(graph: PropertyGraph, batch: DataFrame) -> tuple[PropertyGraph, DataFrame]:
    """Edges and their MENTIONS in one step (both read the same resolution,
    materialised once), and the rejected relations."""
    resolved, rejects = resolve_relations(graph, batch)
    resolved = pinned(resolved)
    return link_mentions(merge_edges(graph, resolved), batch, resolved), rejects


def upsert_triples_with_source(graph: PropertyGraph, batch: DataFrame) -> tuple[PropertyGraph, DataFrame]:
    """Triples and the chunks they come from in one call: each row has the
    relation (label, source_id, target_id, seq) and its source chunk
    (triplet_source_id, text).  Chunks go first, so their MENTIONS resolve."""
    batch = pinned(batch)
    chunks = batch.select(F.col("triplet_source_id").alias("id"), "text", F.lit("text_chunk").alias("label"),
                          *([SEQ] if SEQ in batch.columns else []))
    g, bad = upsert_chunks(graph, chunks)
    g, bad_rel = upsert_relations(g, batch.drop("text"))
    return g, bad_rel.unionByName(bad.select(F.lit(None).cast("string").alias("label"), F.lit(None).cast("string").alias("source_id"),
                                             F.lit(None).cast("string").alias("target_id"), F.col("id").alias("triplet_source_id"), SEQ))


# ------------------------------------------------------------------ delete

def _detach(graph: PropertyGraph, victims: DataFrame) -> PropertyGraph:
    """Remove nodes ``victims(node_table, id)`` and every edge/mention touching them."""
    v = pinned(victims.select("node_table", "id").distinct())
    ents = graph.entities.join(v, ["node_table", "id"], "left_anti")
    chunks = graph.chunks.join(
        v.filter(F.col("node_table") == CHUNK_TABLE).select("id"), "id", "left_anti")
    vs = v.select(F.col("node_table").alias("src_table"), F.col("id").alias("src"))
    vd = v.select(F.col("node_table").alias("dst_table"), F.col("id").alias("dst"))
    edges = graph.edges.join(vs, ["src_table", "src"], "left_anti") \
                       .join(vd, ["dst_table", "dst"], "left_anti")
    vc = v.filter(F.col("node_table") == CHUNK_TABLE).select(F.col("id").alias("chunk_id"))
    ve = v.select(F.col("node_table").alias("entity_table"), F.col("id").alias("entity_id"))
    mentions = graph.mentions.join(vc, "chunk_id", "left_anti") \
                             .join(ve, ["entity_table", "entity_id"], "left_anti")
    return graph.with_(entities=ents, chunks=chunks, edges=edges, mentions=mentions)


def _victims_by(graph: PropertyGraph, col: str, keys: Keys) -> DataFrame:
    nodes = graph.nodes()
    kf = key_frame(graph.spark, keys, "_key")
    return nodes.join(kf, F.col(col) == F.col("_key"), "left_semi").select("node_table", "id")


def delete(graph: PropertyGraph, entity_names: Keys = None, relation_names: Keys = None,
           properties: dict | None = None, ids: Keys = None) -> PropertyGraph:
    """Names, then ids, then relation labels, then properties; node deletes
    cascade to edges and mentions.  Empty lists delete nothing."""
    g = graph
    if entity_names is not None:
        g = _detach(g, _victims_by(g, "name", entity_names))
    if ids is not None:
        g = _detach(g, _victims_by(g, "id", ids))
    if relation_names is not None:
        kf = key_frame(g.spark, relation_names, "label")
        if g.structured:
            pairs = [(h, r, t) for h, r, t in g.rel_schema]
        else:
            pairs = [(GENERIC_ENTITY, GENERIC_RELATION, GENERIC_ENTITY)]
        if g.structured:
            # every (head, tail) pair the label has in the schema
            sdf = F.broadcast(g.spark.createDataFrame(pairs, "src_table string, label string, dst_table string"))
            target = sdf.join(kf, "label", "left_semi")
        else:
            target = kf.withColumn("src_table", F.lit(GENERIC_ENTITY)) \
                       .withColumn("dst_table", F.lit(GENERIC_ENTITY))
        g = g.with_(edges=g.edges.join(target.select("src_table", "label", "dst_table"),
                                       ["src_table", "label", "dst_table"], "left_anti"))
    if properties:
        cond = all_true([F.col(k) == F.lit(v) for k, v in properties.items()])
        victims = g.nodes().filter(F.coalesce(cond, F.lit(False))).select("node_table", "id")
        g = _detach(g, victims)
    return g


def clear(graph: PropertyGraph) -> PropertyGraph:
    """Delete every node and edge (the schema stays)."""
    return graph.with_(entities=graph.entities.limit(0), chunks=graph.chunks.limit(0),
                       edges=graph.edges.limit(0), mentions=graph.mentions.limit(0))


# ------------------------------------------------------------ triple store

def _link_key_join(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    cond = [a["src"] == b["src"], a["predicate"].eqNullSafe(b["predicate"]), a["dst"] == b["dst"]]
    return a.join(b, cond, how)


def _ends(links: DataFrame) -> DataFrame:
    return links.select(F.col("src").alias("id")).unionByName(links.select(F.col("dst").alias("id")))


def triple_upsert(tg: TripleGraph, batch: DataFrame) -> TripleGraph:
    """Insert triples and their endpoint nodes when absent (no-op if present)."""
    new = pinned(conform(batch, LINK_SCHEMA).distinct())
    # the store is searched for the batch's rows: a batch small enough to be
    # broadcast moves no row of the store but those it names
    present = _link_key_join(tg.links, new, "left_semi").distinct()
    fresh = _link_key_join(new, present, "left_anti")
    links = tg.links.unionByName(fresh)
    ends = _ends(new).distinct()
    nodes = tg.nodes.unionByName(ends.join(tg.nodes.join(ends, "id", "left_semi").distinct(), "id", "left_anti"))
    return tg.with_(nodes=nodes, links=links)


def triple_delete(tg: TripleGraph, batch: DataFrame) -> TripleGraph:
    """Delete the triples, then drop each named endpoint left without an edge
    in either direction (even when the triple did not exist)."""
    dead = pinned(conform(batch, LINK_SCHEMA).distinct())
    links = _link_key_join(tg.links, dead, "left_anti")
    named = _ends(dead).distinct()
    # only ends that the batch names matter: the others are never gathered
    touched = _ends(links).join(named, "id", "left_semi").distinct()
    orphans = named.join(touched, "id", "left_anti")
    return tg.with_(nodes=tg.nodes.join(orphans, "id", "left_anti"), links=links)


def orphan_nodes(tg: TripleGraph) -> DataFrame:
    """Nodes without any edge in either direction."""
    touched = tg.links.select(F.col("src").alias("id")).unionByName(tg.links.select(F.col("dst").alias("id"))).distinct()
    return tg.nodes.join(touched, "id", "left_anti")


def orphan_entities(graph: PropertyGraph) -> DataFrame:
    """Entities without any edge in either direction (MENTIONS not counted)."""
    e = graph.edges
    touched = e.select(F.col("src_table").alias("node_table"), F.col("src").alias("id")).unionByName(
        e.select(F.col("dst_table").alias("node_table"), F.col("dst").alias("id"))).distinct()
    return graph.entities.join(touched, ["node_table", "id"], "left_anti")


__all__ = ["latest_by_key", "merge_rows", "upsert_chunks", "upsert_nodes", "route_entities",
           "upsert_entities", "resolve_relations", "merge_edges", "upsert_edges", "link_mentions",
           "upsert_relations", "upsert_triples_with_source", "delete", "clear", "triple_upsert", "triple_delete",
           "orphan_nodes", "orphan_entities", "EDGE_SCHEMA", "MENTION_SCHEMA"]
