"""Node lookups, label scans, triplet retrieval and triple-store reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.model import CHUNK_LABEL, CHUNK_TABLE, PropertyGraph, TripleGraph
from quiver.operators.keys import Keys, all_true, attach, key_frame, restrict

TRIPLET_LIMIT = 100


def get_nodes(graph: PropertyGraph, ids: Keys = None,
              properties: dict | None = None) -> DataFrame:
    """Nodes of every type; ``ids=None`` means all, ``ids=[]`` means none.

    ``properties`` is an AND of equalities; a NULL property never matches.
    """
    nodes = restrict(graph.nodes(), "id", ids)
    if properties:
        nodes = nodes.filter(all_true([F.col(k) == F.lit(v) for k, v in properties.items()]))
    return nodes


def classify_nodes(nodes: DataFrame) -> DataFrame:
    """Chunk vs entity, with the display fallbacks for name and label."""
    is_chunk = F.coalesce(F.col("label") == F.lit(CHUNK_LABEL), F.lit(False))
    return nodes.select(
        "node_table", "id",
        F.when(is_chunk, F.lit("chunk")).otherwise(F.lit("entity")).alias("kind"),
        F.when(is_chunk, F.lit(None).cast("string"))
         .otherwise(F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col("id"))).alias("name"),
        F.when(is_chunk, F.col("label"))
         .otherwise(F.coalesce(F.nullif(F.col("label"), F.lit("")), F.lit(CHUNK_TABLE))).alias("label"),
        F.when(is_chunk, F.col("text")).alias("text"),
    )


def label_scan(graph: PropertyGraph, node_table: str) -> DataFrame:
    """All nodes of one type.  On a snapshot stored ``partitionBy(node_table)``
    this reads one directory (partition pruning)."""
    if node_table == CHUNK_TABLE:
        return graph.nodes().filter(F.col("node_table") == CHUNK_TABLE)
    return graph.entities.filter(F.col("node_table") == F.lit(node_table))


TRIPLET_ORDER = ["src", "label", "dst", "src_table", "dst_table"]


def triplet_edges(graph: PropertyGraph, entity_names: Keys = None, relation_names: Keys = None,
                  ids: Keys = None) -> DataFrame:
    """Edges whose source passes the filters and whose ends both exist.

    Sources must be entities with a non-NULL label other than the chunk label.
    Only key columns of the entities are read."""
    src = graph.entities.filter(
        (F.col("node_table") != F.lit(CHUNK_TABLE)) & F.col("label").isNotNull()
        & (F.col("label") != F.lit(CHUNK_LABEL)))
    src = restrict(restrict(src, "name", entity_names), "id", ids)
    e = restrict(graph.edges, "label", relation_names)
    e = e.select("src_table", "src", "label", "dst_table", "dst", "triplet_source_id")
    return (e.join(src.select(F.col("node_table").alias("src_table"), F.col("id").alias("src")), ["src_table", "src"], "left_semi")
            .join(graph.entities.select(F.col("node_table").alias("dst_table"), F.col("id").alias("dst")),
                  ["dst_table", "dst"], "left_semi"))


def triplets(graph: PropertyGraph, entity_names: Keys = None, relation_names: Keys = None,
             ids: Keys = None, limit: int | None = TRIPLET_LIMIT) -> DataFrame:
    """(source)-[relation]->(target) rows; all given filters are ANDed.

    Filters apply before the limit, and the limit follows a total order so the
    answer is deterministic.  One lazy plan: edges semi-joined with the source
    and target keys, a per-task top-k, then the names of at most ``limit``
    rows."""
    cols = ["src_table", "src", "src_name", "label", "dst_table", "dst", "dst_name", "triplet_source_id"]
    e = triplet_edges(graph, entity_names, relation_names, ids)
    names = graph.entities.select("node_table", "id", "name")
    if limit is None:
        s = names.select(F.col("node_table").alias("src_table"), F.col("id").alias("src"), F.col("name").alias("src_name"))
        d = names.select(F.col("node_table").alias("dst_table"), F.col("id").alias("dst"), F.col("name").alias("dst_name"))
        return e.join(s, ["src_table", "src"]).join(d, ["dst_table", "dst"]).select(*cols)
    top = e.orderBy(*TRIPLET_ORDER, "triplet_source_id").limit(limit)
    named = attach(top, names, ["node_table", "id"], "name", {"src_name": ["src_table", "src"], "dst_name": ["dst_table", "dst"]})
    # at most `limit` rows already: said once more, for the planner of what follows
    return named.select(*cols).orderBy(*TRIPLET_ORDER, "triplet_source_id").limit(limit)


def triple_get(tg: TripleGraph, subjects: Keys) -> DataFrame:
    """(predicate, object) pairs of the given subjects."""
    return restrict(tg.links, "src", subjects).select("src", "predicate", "dst")


def triple_exists(tg: TripleGraph, candidates: DataFrame) -> DataFrame:
    """Candidates with an ``exists`` flag (NULL-safe on the predicate)."""
    l = tg.links.select(F.col("src").alias("_s"), F.col("predicate").alias("_p"),  # links are a set
                        F.col("dst").alias("_d"), F.lit(True).alias("_hit"))
    cond = ((F.col("src") == F.col("_s")) & F.col("predicate").eqNullSafe(F.col("_p"))
            & (F.col("dst") == F.col("_d")))
    return (candidates.join(l, cond, "left")
            .select("src", "predicate", "dst", F.coalesce("_hit", F.lit(False)).alias("exists")))


def node_exists(tg: TripleGraph, ids: Keys) -> DataFrame:
    """Each asked id with an ``exists`` flag."""
    asked = key_frame(tg.nodes.sparkSession, ids, "id")
    have = tg.nodes.select(F.col("id").alias("_id"), F.lit(True).alias("_hit"))
    return asked.join(have, F.col("id") == F.col("_id"), "left").select("id", F.coalesce("_hit", F.lit(False)).alias("exists"))
