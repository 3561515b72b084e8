"""Registered queries: one per operator, each with its DuckDB oracle.

Every query reads the input tables under ``sf_dir`` (or data Spark derives from
them), so its work grows with the tables.  Seeds, names and other operator
arguments are derived from the data too, never hard-coded id lists.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiver.functions.text import prefixed_id
from quiver.model import PropertyGraph
from quiver.operators import lookup, merge, traverse
from quiver.plans import graphs
from quiver.plans import sql_fragments as S
from quiver.sources import adjacency
from quiver.sources.tables import read_table, table_state

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


TRIPLET_COLS = "src_table, src, src_name, label, dst_table, dst, dst_name, triplet_source_id"


def _triplet_oracle(src_filter: str = "TRUE", edge_filter: str = "TRUE", extra: tuple = ()) -> str:
    return S.with_(S.STAR_ENTITIES, S.STAR_EDGES, *extra) + f"""
SELECT e.src_table, e.src, s.name AS src_name, e.label, e.dst_table, e.dst, d.name AS dst_name,
       e.triplet_source_id
FROM star_edges e
JOIN star_entities s ON s.node_table = e.src_table AND s.id = e.src
JOIN star_entities d ON d.node_table = e.dst_table AND d.id = e.dst
WHERE s.node_table <> 'Chunk' AND s.label IS NOT NULL AND s.label <> 'text_chunk'
  AND ({src_filter}) AND ({edge_filter})
ORDER BY e.src, e.label, e.dst, e.src_table, e.dst_table
LIMIT 100"""


# data-derived arguments ----------------------------------------------------

def europe_supplier_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names of suppliers based in a nation of region EUROPE."""
    s = read_table(spark, sf, "supplier", "s_name", "s_nationkey")
    n = read_table(spark, sf, "nation", "n_nationkey", "n_regionkey")
    r = read_table(spark, sf, "region", "r_regionkey", "r_name").filter(F.col("r_name") == "EUROPE")
    return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("s_name").alias("name")))


EUROPE_SUPPLIER_NAMES_SQL = """europe_suppliers AS (
  SELECT s_name AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'
)"""


def segment_customer_ids(spark: SparkSession, sf: str, segment: str) -> DataFrame:
    c = read_table(spark, sf, "customer", "c_custkey", "c_mktsegment")
    return c.filter(F.col("c_mktsegment") == segment).select(prefixed_id("c:", F.col("c_custkey")).alias("id"))


def _segment_ids_sql(name: str, segment: str) -> str:
    return f"""{name} AS (SELECT 'c:' || CAST(c_custkey AS VARCHAR) AS id FROM customer
  WHERE c_mktsegment = '{segment}')"""


# D1-D6 triplets ------------------------------------------------------------

@register("triplets_limit", _triplet_oracle())
def q_triplets_limit(spark, sf):
    return lookup.triplets(graphs.star_graph(spark, sf))


@register("triplets_by_entity", _triplet_oracle(
    "s.name IN (SELECT name FROM europe_suppliers)", extra=(EUROPE_SUPPLIER_NAMES_SQL,)))
def q_triplets_by_entity(spark, sf):
    return lookup.triplets(graphs.star_graph(spark, sf), entity_names=europe_supplier_names(spark, sf))


@register("triplets_by_relation", _triplet_oracle(edge_filter="e.label IN ('BASED_IN', 'IN_REGION')"))
def q_triplets_by_relation(spark, sf):
    return lookup.triplets(graphs.star_graph(spark, sf), relation_names=["BASED_IN", "IN_REGION"])


@register("triplets_by_id", _triplet_oracle(
    "s.id IN (SELECT id FROM machinery)", extra=(_segment_ids_sql("machinery", "MACHINERY"),)))
def q_triplets_by_id(spark, sf):
    return lookup.triplets(graphs.star_graph(spark, sf), ids=segment_customer_ids(spark, sf, "MACHINERY"))


@register("triplets_combined", _triplet_oracle(
    "s.name IN (SELECT name FROM europe_suppliers) AND s.id IN (SELECT id FROM pos_suppliers)",
    "e.label IN ('SUPPLIES')",
    extra=(EUROPE_SUPPLIER_NAMES_SQL,
           "pos_suppliers AS (SELECT 's:' || CAST(s_suppkey AS VARCHAR) AS id FROM supplier WHERE s_acctbal > 0)")))
def q_triplets_combined(spark, sf):
    pos = (read_table(spark, sf, "supplier", "s_suppkey", "s_acctbal").filter(F.col("s_acctbal") > 0)
           .select(prefixed_id("s:", F.col("s_suppkey")).alias("id")))
    return lookup.triplets(graphs.star_graph(spark, sf), entity_names=europe_supplier_names(spark, sf),
                           relation_names=["SUPPLIES"], ids=pos)


# C1-C7, B13, C9-C11 node reads -----------------------------------------------

NODE_COLS = ["node_table", "id", "name", "label", "file_name", "ref_doc_id", "text"]

TEXT_NODES_SQL = """text_nodes AS (
  SELECT node_table, id, name, label, CAST(NULL AS VARCHAR) AS file_name, CAST(NULL AS VARCHAR) AS ref_doc_id,
         CAST(NULL AS VARCHAR) AS text, CAST(NULL AS VARCHAR) AS file_type FROM text_entities
  UNION ALL
  SELECT 'Chunk', id, NULL, label, file_name, ref_doc_id, text, file_type FROM text_chunks
)"""

_TEXT_BASE = (S.TEXT_CHUNKS, S.TEXT_ENTITIES, TEXT_NODES_SQL)


@register("get_all_nodes", S.with_(*_TEXT_BASE) + "SELECT node_table, id, name, label, file_name, ref_doc_id, text FROM text_nodes")
def q_get_all_nodes(spark, sf):
    return lookup.get_nodes(graphs.text_graph(spark, sf)).select(*NODE_COLS)


def german_node_ids(spark, sf) -> DataFrame:
    """Chunks of German documents plus the German language entity."""
    d = read_table(spark, sf, "documents", "doc_id", "lang").filter(F.col("lang") == "de")
    return d.select(prefixed_id("d:", F.col("doc_id")).alias("id")).unionByName(
        d.select(prefixed_id("lang:", F.col("lang")).alias("id")))


GERMAN_IDS_SQL = """german_ids AS (
  SELECT 'd:' || CAST(doc_id AS VARCHAR) AS id FROM documents WHERE lang = 'de'
  UNION SELECT 'lang:' || lang FROM documents WHERE lang = 'de'
)"""


@register("get_nodes_by_id", S.with_(*_TEXT_BASE, GERMAN_IDS_SQL) +
          "SELECT node_table, id, name, label, file_name, ref_doc_id, text FROM text_nodes "
          "WHERE id IN (SELECT id FROM german_ids)")
def q_get_nodes_by_id(spark, sf):
    return lookup.get_nodes(graphs.text_graph(spark, sf), ids=german_node_ids(spark, sf)).select(*NODE_COLS)


@register("classify_nodes", S.with_(*_TEXT_BASE) + """
SELECT node_table, id,
       CASE WHEN coalesce(label = 'text_chunk', FALSE) THEN 'chunk' ELSE 'entity' END AS kind,
       CASE WHEN coalesce(label = 'text_chunk', FALSE) THEN NULL ELSE coalesce(nullif(name, ''), id) END AS name,
       CASE WHEN coalesce(label = 'text_chunk', FALSE) THEN label ELSE coalesce(nullif(label, ''), 'Chunk') END AS label,
       CASE WHEN coalesce(label = 'text_chunk', FALSE) THEN text END AS text
FROM text_nodes""")
def q_classify_nodes(spark, sf):
    return lookup.classify_nodes(lookup.get_nodes(graphs.text_graph(spark, sf)))


@register("get_nodes_by_property", S.with_(*_TEXT_BASE) +
          "SELECT node_table, id, name, label, file_name, ref_doc_id, text FROM text_nodes "
          "WHERE file_name = 'src3' AND file_type = 'text/plain'")
def q_get_nodes_by_property(spark, sf):
    g = graphs.text_graph(spark, sf)
    return lookup.get_nodes(g, properties={"file_name": "src3", "file_type": "text/plain"}).select(*NODE_COLS)


@register("label_scan", S.with_(S.STAR_ENTITIES) +
          "SELECT node_table, id, name, label FROM star_entities WHERE node_table = 'SUPPLIER'")
def q_label_scan(spark, sf):
    return lookup.label_scan(graphs.star_graph(spark, sf), "SUPPLIER").select("node_table", "id", "name", "label")


@register("get_text_nodes", S.with_(S.TEXT_CHUNKS) +
          "SELECT id, text, ref_doc_id FROM text_chunks WHERE file_name = 'src7'")
def q_get_text_nodes(spark, sf):
    g = graphs.text_graph(spark, sf)
    ids = (read_table(spark, sf, "documents", "doc_id", "source").filter(F.col("source") == "src7")
           .select(prefixed_id("d:", F.col("doc_id")).alias("id")))
    return lookup.get_nodes(g, ids=ids).filter(F.col("node_table") == "Chunk").select("id", "text", "ref_doc_id")


@register("triple_get", S.with_(S.CHAIN_LINKS, _segment_ids_sql("building", "BUILDING")) +
          "SELECT src, predicate, dst FROM chain_links WHERE src IN (SELECT id FROM building)")
def q_triple_get(spark, sf):
    return lookup.triple_get(graphs.chain_graph(spark, sf), segment_customer_ids(spark, sf, "BUILDING"))


@register("triple_exists", S.with_(S.CHAIN_LINKS) + """,
cand AS (
  SELECT 'c:' || CAST(o_custkey AS VARCHAR) AS src, 'PLACED' AS predicate, 'o:' || CAST(o_orderkey AS VARCHAR) AS dst FROM orders
  UNION ALL
  SELECT 'o:' || CAST(o_orderkey AS VARCHAR), 'PLACED', 'c:' || CAST(o_custkey AS VARCHAR) FROM orders
)
SELECT c.src, c.predicate, c.dst,
       EXISTS (SELECT 1 FROM chain_links l WHERE l.src = c.src AND l.predicate = c.predicate AND l.dst = c.dst) AS "exists"
FROM cand c""")
def q_triple_exists(spark, sf):
    o = read_table(spark, sf, "orders", "o_custkey", "o_orderkey")
    c, k = prefixed_id("c:", F.col("o_custkey")), prefixed_id("o:", F.col("o_orderkey"))
    cand = o.select(c.alias("src"), F.lit("PLACED").alias("predicate"), k.alias("dst")).unionByName(
        o.select(k.alias("src"), F.lit("PLACED").alias("predicate"), c.alias("dst")))
    return lookup.triple_exists(graphs.chain_graph(spark, sf), cand)


@register("node_exists", S.with_(S.CHAIN_LINKS) + """
SELECT id, EXISTS (SELECT 1 FROM chain_nodes c WHERE c.id = a.id) AS "exists" FROM (
  SELECT DISTINCT 'c:' || c_custkey AS id FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION SELECT 'x:' || r_regionkey FROM region) a""")
def q_node_exists(spark, sf):
    r = read_table(spark, sf, "region", "r_regionkey")
    asked = segment_customer_ids(spark, sf, "BUILDING").unionByName(r.select(prefixed_id("x:", F.col("r_regionkey")).alias("id")))
    return lookup.node_exists(graphs.chain_graph(spark, sf), asked)


# G1, G2, G4, S1-S6 schema -----------------------------------------------------

from quiver.operators import schema as schema_ops  # noqa: E402

_STAR_TABLES = "star_tables AS (SELECT DISTINCT node_table FROM star_entities UNION SELECT 'Chunk')"


ENTITY_PROPS_SQL = """entity_props(pos, property, type) AS (VALUES
  (0, 'id', 'STRING'), (1, 'name', 'STRING'), (2, 'label', 'STRING'), (3, 'creation_date', 'DATE'),
  (4, 'last_modified_date', 'DATE'), (5, 'file_name', 'STRING'), (6, 'file_path', 'STRING'),
  (7, 'file_size', 'INT64'), (8, 'file_type', 'STRING'), (9, 'triplet_source_id', 'STRING'))"""

CHUNK_PROPS_SQL = """chunk_props(pos, property, type) AS (VALUES
  (0, 'id', 'STRING'), (1, 'text', 'STRING'), (2, 'label', 'STRING'), (3, 'embedding', 'DOUBLE[]'),
  (4, 'creation_date', 'DATE'), (5, 'last_modified_date', 'DATE'), (6, 'file_name', 'STRING'),
  (7, 'file_path', 'STRING'), (8, 'file_size', 'INT64'), (9, 'file_type', 'STRING'), (10, 'ref_doc_id', 'STRING'))"""

EDGE_PROPS_SQL = """edge_props(pos, property, type) AS (VALUES (0, 'label', 'STRING'), (1, 'triplet_source_id', 'STRING'))"""

NODE_PROPS_SQL = """node_props AS (
  SELECT t.node_table, p.pos, p.property, p.type FROM star_tables t, entity_props p WHERE t.node_table <> 'Chunk'
  UNION ALL
  SELECT t.node_table, p.pos, p.property, p.type FROM star_tables t, chunk_props p WHERE t.node_table = 'Chunk'
)"""

REL_PROPS_SQL = """rel_props AS (
  SELECT l.label, p.pos, p.property, p.type FROM (SELECT DISTINCT label FROM star_edges WHERE label IS NOT NULL) l, edge_props p
)"""

RELS_SQL = """rels AS (SELECT DISTINCT src_table AS start, label AS type, dst_table AS "end" FROM star_edges WHERE label IS NOT NULL)"""

_SCHEMA_BASE = (S.STAR_ENTITIES, S.STAR_EDGES, _STAR_TABLES, ENTITY_PROPS_SQL, CHUNK_PROPS_SQL,
                EDGE_PROPS_SQL, NODE_PROPS_SQL, REL_PROPS_SQL, RELS_SQL)


@register("schema_node_props", S.with_(*_SCHEMA_BASE) + "SELECT node_table, pos, property, type FROM node_props")
def q_schema_node_props(spark, sf):
    return schema_ops.node_props(graphs.star_graph(spark, sf))


@register("schema_rel_props", S.with_(*_SCHEMA_BASE) + "SELECT label, pos, property, type FROM rel_props")
def q_schema_rel_props(spark, sf):
    return schema_ops.rel_props(graphs.star_graph(spark, sf))


@register("schema_relationships", S.with_(*_SCHEMA_BASE) + 'SELECT start, type, "end" FROM rels')
def q_schema_relationships(spark, sf):
    return schema_ops.relationships(graphs.star_graph(spark, sf))


@register("schema_entities", S.with_(*_SCHEMA_BASE) +
          'SELECT DISTINCT entity_type FROM (SELECT start AS entity_type FROM rels UNION ALL SELECT "end" FROM rels)')
def q_schema_entities(spark, sf):
    return schema_ops.entity_types(schema_ops.relationships(graphs.star_graph(spark, sf)))


@register("schema_text", S.with_(*_SCHEMA_BASE) + """,
node_lines AS (SELECT node_table AS k, node_table || ' {' || string_agg(property || ': ' || type, ', ' ORDER BY pos) || '}' AS s
               FROM node_props GROUP BY node_table),
rel_lines AS (SELECT label AS k, label || ' {' || string_agg(property || ': ' || type, ', ' ORDER BY pos) || '}' AS s
              FROM rel_props GROUP BY label),
rs_lines AS (SELECT start || chr(1) || type || chr(1) || "end" AS k, '(:' || start || ')-[:' || type || ']->(:' || "end" || ')' AS s FROM rels)
SELECT concat_ws(chr(10), 'Node properties:', (SELECT string_agg(s, chr(10) ORDER BY k) FROM node_lines),
       'Relationship properties:', (SELECT string_agg(s, chr(10) ORDER BY k) FROM rel_lines),
       'The relationships:', (SELECT string_agg(s, chr(10) ORDER BY k) FROM rs_lines)) AS schema""")
def q_schema_text(spark, sf):
    return schema_ops.schema_text(graphs.star_graph(spark, sf))


@register("count_nodes", S.with_(*_TEXT_BASE) + "SELECT node_table, count(*) AS n FROM text_nodes GROUP BY node_table")
def q_count_nodes(spark, sf):
    return graphs.text_graph(spark, sf).nodes().groupBy("node_table").agg(F.count(F.lit(1)).alias("n"))


@register("distinct_relation_labels", S.with_(S.STAR_EDGES) +
          "SELECT DISTINCT rel_table, label FROM star_edges")
def q_distinct_relation_labels(spark, sf):
    return graphs.star_graph(spark, sf).edges.select("rel_table", "label").distinct()


_CHAIN_TYPED = """typed AS (
  SELECT l.src, s.node_table AS head, l.predicate, l.dst, d.node_table AS tail
  FROM chain_links l JOIN star_entities s ON s.id = l.src JOIN star_entities d ON d.id = l.dst
),
star_schema(head, predicate, tail) AS (VALUES ('CUSTOMER', 'PLACED', 'ORDER'), ('ORDER', 'CONTAINS', 'PART'),
  ('SUPPLIER', 'SUPPLIES', 'PART'), ('CUSTOMER', 'LIVES_IN', 'NATION'), ('SUPPLIER', 'BASED_IN', 'NATION'),
  ('NATION', 'IN_REGION', 'REGION'))"""


def _typed_chain(spark, sf):
    return schema_ops.typed_triples(graphs.chain_links(spark, sf), graphs.star_entities(spark, sf))


@register("schema_conformance", S.with_(S.STAR_ENTITIES, S.CHAIN_LINKS, _CHAIN_TYPED) + """
SELECT src, head, predicate, dst, tail FROM typed t
WHERE EXISTS (SELECT 1 FROM star_schema s WHERE s.head = t.head AND s.predicate = t.predicate AND s.tail = t.tail)""")
def q_schema_conformance(spark, sf):
    return schema_ops.conforming(_typed_chain(spark, sf), graphs.STAR_SCHEMA)


@register("schema_rejects", S.with_(S.STAR_ENTITIES, S.CHAIN_LINKS, _CHAIN_TYPED) + """
SELECT src, head, predicate, dst, tail FROM typed t
WHERE NOT EXISTS (SELECT 1 FROM star_schema s WHERE s.head = t.head AND s.predicate = t.predicate AND s.tail = t.tail)""")
def q_schema_rejects(spark, sf):
    return schema_ops.rejects(_typed_chain(spark, sf), graphs.STAR_SCHEMA)


# D7-D10, D14 traversal -----------------------------------------------------------

def _paths_oracle(seed_sql: str, depth: int, limit: int, edges: str = "star_edges",
                  edge_filter: str = "label IS NOT NULL AND label <> 'MENTIONS'",
                  extra: tuple = (S.STAR_ENTITIES, S.STAR_EDGES)) -> str:
    levels = [f"""p1 AS (SELECT s.start_table, s.start, 1 AS hops, s.start || '|' || e.label || '|' || e.dst AS path,
       s.start_table || '|' || e.dst_table AS path_tables, e.dst_table AS cur_table, e.dst AS cur,
       [s.start, e.label, e.dst] AS seq, [s.start_table, e.dst_table] AS tseq,
       e.src_table AS s1t, e.src AS s1, e.label AS l1, e.dst_table AS d1t, e.dst AS d1, e.triplet_source_id AS t1
  FROM seeds s JOIN w e ON e.src_table = s.start_table AND e.src = s.start)"""]
    hop_cols = ["s1t", "s1", "l1", "d1t", "d1", "t1"]
    for h in range(2, depth + 1):
        prev_cols = ", ".join(f"p.{c}" for c in hop_cols)
        levels.append(f"""p{h} AS (SELECT p.start_table, p.start, {h} AS hops, p.path || '|' || e.label || '|' || e.dst AS path,
       p.path_tables || '|' || e.dst_table AS path_tables, e.dst_table AS cur_table, e.dst AS cur, {prev_cols},
       list_concat(p.seq, [e.label, e.dst]) AS seq, list_concat(p.tseq, [e.dst_table]) AS tseq,
       e.src_table AS s{h}t, e.src AS s{h}, e.label AS l{h}, e.dst_table AS d{h}t, e.dst AS d{h},
       e.triplet_source_id AS t{h}
  FROM p{h - 1} p JOIN w e ON e.src_table = p.cur_table AND e.src = p.cur)""")
        hop_cols += [f"s{h}t", f"s{h}", f"l{h}", f"d{h}t", f"d{h}", f"t{h}"]
    union = []
    for h in range(1, depth + 1):
        cols = []
        for k in range(1, depth + 1):
            for c in (f"s{k}t", f"s{k}", f"l{k}", f"d{k}t", f"d{k}", f"t{k}"):
                cols.append(c if k <= h else f"NULL AS {c}")
        union.append(f"SELECT start_table, start, hops, path, path_tables, seq, tseq, {', '.join(cols)} FROM p{h}")
    body = ",\n".join([f"w AS (SELECT src_table, src, label, dst_table, dst, triplet_source_id FROM {edges} "
                        f"WHERE {edge_filter})",
                       seed_sql] + levels)
    return S.with_(*extra, body) + f""",
paths AS (SELECT * FROM ({' UNION ALL '.join(union)}) ORDER BY seq, tseq LIMIT {limit})
"""


_BUILDING_SEEDS = """seeds AS (SELECT 'CUSTOMER' AS start_table, 'c:' || CAST(c_custkey AS VARCHAR) AS start
  FROM customer WHERE c_mktsegment = 'BUILDING')"""
_ALL_SEEDS = """seeds AS (SELECT node_table AS start_table, id AS start FROM star_entities)"""


def _hops_sql(depth: int, ignore: tuple = ()) -> str:
    parts = []
    for k in range(1, depth + 1):
        parts.append(f"SELECT path, {k} AS hop, s{k}t AS src_table, s{k} AS src, l{k} AS label, d{k}t AS dst_table, "
                     f"d{k} AS dst FROM paths WHERE hops >= {k}")
    where = ""
    if ignore:
        where = " WHERE NOT coalesce(h.label IN (" + ", ".join(f"'{x}'" for x in ignore) + "), FALSE)"
    return f"""SELECT h.path, h.hop, h.src_table, h.src, sn.name AS src_name, h.label, h.dst_table, h.dst, dn.name AS dst_name
FROM ({' UNION ALL '.join(parts)}) h
LEFT JOIN star_entities sn ON sn.node_table = h.src_table AND sn.id = h.src
LEFT JOIN star_entities dn ON dn.node_table = h.dst_table AND dn.id = h.dst{where}"""


PATH_COLS = ["start_table", "start", "hops", "path", "path_tables"]


@register("rel_map_paths", _paths_oracle(_BUILDING_SEEDS, 2, 30) +
          "SELECT start_table, start, hops, path, path_tables FROM paths")
def q_rel_map_paths(spark, sf):
    g = graphs.star_graph(spark, sf)
    return traverse.rel_map_paths(g, segment_customer_ids(spark, sf, "BUILDING"), 2, 30).select(*PATH_COLS)


@register("rel_map_triplets", _paths_oracle(_BUILDING_SEEDS, 2, 30) + _hops_sql(2))
def q_rel_map_triplets(spark, sf):
    g = graphs.star_graph(spark, sf)
    return traverse.rel_map(g, segment_customer_ids(spark, sf, "BUILDING"), 2, 30)


@register("rel_map_ignore_rels", _paths_oracle(_BUILDING_SEEDS, 2, 30) + _hops_sql(2, ("LIVES_IN",)))
def q_rel_map_ignore_rels(spark, sf):
    g = graphs.star_graph(spark, sf)
    return traverse.rel_map(g, segment_customer_ids(spark, sf, "BUILDING"), 2, 30, ignore_rels=["LIVES_IN"])


@register("rel_map_all", _paths_oracle(_ALL_SEEDS, 2, 30) + _hops_sql(2))
def q_rel_map_all(spark, sf):
    return traverse.rel_map(graphs.star_graph(spark, sf), None, 2, 30)


def _stored_edges(spark, edges) -> adjacency.Adjacency:
    """The edges as an adjacency table, written and opened again."""
    root = scratch_path(spark, "adjacency")
    adjacency.write_adjacency(edges, root)
    return adjacency.open_adjacency(spark, root)


@register("rel_map_stored", _paths_oracle(_BUILDING_SEEDS, 2, 30) + _hops_sql(2))
def q_rel_map_stored(spark, sf):
    g = graphs.star_graph(spark, sf)
    return traverse.rel_map(g, segment_customer_ids(spark, sf, "BUILDING"), 2, 30,
                            adjacency=_stored_edges(spark, adjacency.graph_edges(g)))


@register("rel_map_all_stored", _paths_oracle(_ALL_SEEDS, 2, 30) + _hops_sql(2))
def q_rel_map_all_stored(spark, sf):
    g = graphs.star_graph(spark, sf)
    return traverse.rel_map(g, None, 2, 30, adjacency=_stored_edges(spark, adjacency.graph_edges(g)))


def _triple_paths_oracle(depth: int, limit: int) -> str:
    seeds = """seeds AS (SELECT 'n' AS start_table, id AS start FROM chain_nodes
  WHERE id IN (SELECT 'c:' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING'))"""
    w = ("chain_w AS (SELECT 'n' AS src_table, src, predicate AS label, 'n' AS dst_table, dst, "
         "CAST(NULL AS VARCHAR) AS triplet_source_id FROM chain_links)")
    return _paths_oracle(seeds, depth, limit, edges="chain_w", edge_filter="TRUE",
                         extra=(S.CHAIN_LINKS, w)) + "SELECT start AS subj, hops, path FROM paths"


@register("triple_rel_map", _triple_paths_oracle(2, 30))
def q_triple_rel_map(spark, sf):
    return traverse.triple_rel_map(graphs.chain_graph(spark, sf), segment_customer_ids(spark, sf, "BUILDING"), 2, 30)


@register("triple_rel_map_depth3", _triple_paths_oracle(3, 30))
def q_triple_rel_map_depth3(spark, sf):
    return traverse.triple_rel_map(graphs.chain_graph(spark, sf), segment_customer_ids(spark, sf, "BUILDING"), 3, 30)


@register("triple_rel_map_stored", _triple_paths_oracle(3, 30))
def q_triple_rel_map_stored(spark, sf):
    tg = graphs.chain_graph(spark, sf)
    return traverse.triple_rel_map(tg, segment_customer_ids(spark, sf, "BUILDING"), 3, 30,
                                   adjacency=_stored_edges(spark, adjacency.triple_edges(tg)))


@register("orphan_nodes", S.with_(S.STAR_ENTITIES, S.STAR_EDGES) + """,
kept AS (SELECT * FROM star_edges WHERE label <> 'IN_REGION')
SELECT node_table, id, name FROM star_entities n
WHERE NOT EXISTS (SELECT 1 FROM kept e WHERE (e.src_table = n.node_table AND e.src = n.id)
                                          OR (e.dst_table = n.node_table AND e.dst = n.id))""")
def q_orphan_nodes(spark, sf):
    g = merge.delete(graphs.star_graph(spark, sf), relation_names=["IN_REGION"])
    return merge.orphan_entities(g).select("node_table", "id", "name")


TWO_HOP = [("c", "CUSTOMER", "PLACED", "o", "ORDER"), ("o", "ORDER", "CONTAINS", "p", "PART")]

# a cycle: the customer and the supplier of a part in the customer's order
# live in the same nation
LOCAL_SUPPLY_CYCLE = [
    ("c", "CUSTOMER", "PLACED", "o", "ORDER"),
    ("c", "CUSTOMER", "LIVES_IN", "n", "NATION"),
    ("o", "ORDER", "CONTAINS", "p", "PART"),
    ("s", "SUPPLIER", "SUPPLIES", "p", "PART"),
    ("s", "SUPPLIER", "BASED_IN", "n", "NATION"),
]


@register("match_two_hop", """
SELECT 'c:' || o_custkey AS c, 'o:' || o_orderkey AS o, 'p:' || l_partkey AS p
FROM orders JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) ON l_orderkey = o_orderkey""")
def q_match_two_hop(spark, sf):
    return traverse.match(graphs.star_graph(spark, sf), TWO_HOP)


@register("match_cycle", """
SELECT 'c:' || o_custkey AS c, 'o:' || o_orderkey AS o, 'n:' || c_nationkey AS n, 'p:' || co.l_partkey AS p, 's:' || s_suppkey AS s
FROM orders JOIN customer ON c_custkey = o_custkey
JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) co ON co.l_orderkey = o_orderkey
JOIN (SELECT DISTINCT l_suppkey, l_partkey, s_suppkey, s_nationkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey) su
  ON su.l_partkey = co.l_partkey AND su.s_nationkey = c_nationkey""")
def q_match_cycle(spark, sf):
    return traverse.match(graphs.star_graph(spark, sf), LOCAL_SUPPLY_CYCLE)


# the same cycle with the nation bound last: customers and suppliers of a nation
# meet there, and the nations with many of both are hubs
HUB_CYCLE = [LOCAL_SUPPLY_CYCLE[i] for i in (0, 2, 3, 1, 4)]


@register("match_cycle_hub", ORACLES["match_cycle"])
def q_match_cycle_hub(spark, sf):
    return traverse.match(graphs.star_graph(spark, sf), HUB_CYCLE, heavy=3)


# customers and the parts of their orders (one pair however many orders), a
# supplier of the part, and the region both the supplier and the customer are in
REGION_REACH = [
    ("c", "CUSTOMER", traverse.Hops(("PLACED", "CONTAINS"), 1, 2), "p", "PART"),
    ("c", "CUSTOMER", traverse.Hops(("LIVES_IN", "IN_REGION"), 1, 2), "r", "REGION"),
    ("s", "SUPPLIER", "SUPPLIES", "p", "PART"),
    ("s", "SUPPLIER", traverse.Hops(("BASED_IN", "IN_REGION"), 2, 3), "r", "REGION"),
]


@register("match_reach", """
WITH cp AS (SELECT DISTINCT o_custkey, l_partkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
sp AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem),
cr AS (SELECT c_custkey, n_regionkey FROM customer JOIN nation ON n_nationkey = c_nationkey),
sr AS (SELECT s_suppkey, n_regionkey FROM supplier JOIN nation ON n_nationkey = s_nationkey)
SELECT 'c:' || o_custkey AS c, 'p:' || cp.l_partkey AS p, 'r:' || cr.n_regionkey AS r, 's:' || s_suppkey AS s
FROM cp JOIN cr ON c_custkey = o_custkey JOIN sp ON sp.l_partkey = cp.l_partkey
JOIN sr ON s_suppkey = l_suppkey AND sr.n_regionkey = cr.n_regionkey""")
def q_match_reach(spark, sf):
    return traverse.match(graphs.star_graph(spark, sf), REGION_REACH)


GRAPH_SQL = """SELECT n.name AS nation, count(*) AS n_members
FROM g_edges e JOIN g_entities n ON n.node_table = e.dst_table AND n.id = e.dst
WHERE e.label = :label GROUP BY n.name"""


@register("sql_over_graph", S.with_(S.STAR_ENTITIES, S.STAR_EDGES) + """
SELECT n.name AS nation, count(*) AS n_members
FROM star_edges e JOIN star_entities n ON n.node_table = e.dst_table AND n.id = e.dst
WHERE e.label = 'LIVES_IN' GROUP BY n.name""")
def q_sql_over_graph(spark, sf):
    g = graphs.star_graph(spark, sf)
    g.register_views("g_")
    return spark.sql(GRAPH_SQL, args={"label": "LIVES_IN"})


# B1-B11, B13/B14 mutations ---------------------------------------------------------

from quiver.sources import snapshots  # noqa: E402
from quiver.session import checkpoint_root, materialize, scratch_path  # noqa: E402


def chunk_batch(spark, sf) -> DataFrame:
    """Chunk upserts derived from documents of source src3.

    seq 1 rewrites each chunk (text padded with ASCII and Unicode blanks that
    must be stripped, no embedding, a date that does not parse for German
    documents); seq 2 rewrites English ones again; new chunk ids are added.
    Rows without id and rows with a vector of one number must be rejected."""
    d = read_table(spark, sf, "documents", "doc_id", "text", "lang", "source").filter(F.col("source") == "src3")
    base = dict(label=F.lit("text_chunk"), file_name=F.col("source"), ref_doc_id=F.col("doc_id").cast("string"))
    date = F.when(F.col("lang") == "de", F.lit("not-a-date")).otherwise(F.lit("2024-05-17"))
    v1 = d.select(prefixed_id("d:", F.col("doc_id")).alias("id"),
                  F.concat(F.lit("\u00a0 \u2003\x1c"), F.col("text"), F.lit("\n\t\u3000\u00a0")).alias("text"),
                  *[c.alias(k) for k, c in base.items()], date.alias("creation_date"), F.lit(1).alias("seq"))
    v2 = d.filter(F.col("lang") == "en").select(
        prefixed_id("d:", F.col("doc_id")).alias("id"), F.concat(F.col("text"), F.lit(" (rev)")).alias("text"),
        *[c.alias(k) for k, c in base.items()], F.lit("2024-06-01").alias("creation_date"), F.lit(2).alias("seq"))
    new = d.select(F.concat(prefixed_id("d:", F.col("doc_id")), F.lit(":v2")).alias("id"), F.col("text"),
                   *[c.alias(k) for k, c in base.items()], F.lit("2024-07-01").alias("creation_date"),
                   F.lit(1).alias("seq"))
    none = F.lit(None).cast("array<double>")
    bad = new.withColumn("id", F.when(F.col("seq") == 1, F.concat("id", F.lit(":bad")))).withColumn("embedding", F.array(F.lit(1.0)))
    nameless = v2.withColumn("id", F.lit(None).cast("string"))
    good = v1.unionByName(v2).unionByName(new).unionByName(nameless).withColumn("embedding", none)
    return good.unionByName(bad)


CHUNK_BATCH_SQL = """batch AS (
  SELECT 'd:' || CAST(doc_id AS VARCHAR) AS id, text, 'text_chunk' AS label, CAST(NULL AS DOUBLE[]) AS embedding,
         CASE WHEN lang = 'de' THEN NULL ELSE DATE '2024-05-17' END AS creation_date, source AS file_name,
         CAST(doc_id AS VARCHAR) AS ref_doc_id, 1 AS seq FROM documents WHERE source = 'src3'
  UNION ALL
  SELECT 'd:' || CAST(doc_id AS VARCHAR), text || ' (rev)', 'text_chunk', NULL, DATE '2024-06-01', source,
         CAST(doc_id AS VARCHAR), 2 FROM documents WHERE source = 'src3' AND lang = 'en'
  UNION ALL
  SELECT 'd:' || CAST(doc_id AS VARCHAR) || ':v2', text, 'text_chunk', NULL, DATE '2024-07-01', source,
         CAST(doc_id AS VARCHAR), 1 FROM documents WHERE source = 'src3'
),
latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM batch) WHERE rn = 1)"""


@register("upsert_chunks", S.with_(S.TEXT_CHUNKS, CHUNK_BATCH_SQL) + """
SELECT id, text, label, CAST(len(embedding) AS INTEGER) AS n_dims, CAST(creation_date AS VARCHAR) AS creation_date, file_name, ref_doc_id
FROM (SELECT id, text, label, embedding, CAST(NULL AS DATE) AS creation_date, file_name, ref_doc_id FROM text_chunks
      WHERE id NOT IN (SELECT id FROM latest)
      UNION ALL SELECT id, text, label, embedding, creation_date, file_name, ref_doc_id FROM latest)""")
def q_upsert_chunks(spark, sf):
    g, _ = merge.upsert_chunks(graphs.text_graph(spark, sf), chunk_batch(spark, sf))
    c = g.chunks
    return c.select("id", "text", "label",
                    F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("n_dims"),
                    F.col("creation_date").cast("string").alias("creation_date"), "file_name", "ref_doc_id")


@register("chunk_rejects", """
SELECT 'd:' || doc_id || ':v2:bad' AS id, 1 AS n_dims, 1 AS seq FROM documents WHERE source = 'src3'
UNION ALL SELECT NULL, NULL, 2 FROM documents WHERE source = 'src3' AND lang = 'en'""")
def q_chunk_rejects(spark, sf):
    bad = merge.upsert_chunks(graphs.text_graph(spark, sf), chunk_batch(spark, sf))[1]
    return bad.select("id", F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("n_dims"), "seq")


def mixed_batch(spark, sf) -> DataFrame:
    """Chunks, nations under new names, and rows of a kind no table takes."""
    d, n = read_table(spark, sf, "documents", "doc_id", "text"), read_table(spark, sf, "nation", "n_nationkey", "n_name")
    none = F.lit(None).cast("string")
    rows = (d.select(F.lit("chunk").alias("kind"), prefixed_id("d:", F.col("doc_id")).alias("id"), none.alias("name"),
                     F.lit("text_chunk").alias("label"), "text")
            .unionByName(n.select(F.lit("entity").alias("kind"), prefixed_id("n:", F.col("n_nationkey")).alias("id"),
                                  F.lower("n_name").alias("name"), F.lit("NATION").alias("label"), none.alias("text")))
            .unionByName(n.select(F.lit("entity").alias("kind"), F.col("n_name").alias("id"), none.alias("name"),
                                  F.lit("PLANET").alias("label"), none.alias("text")))
            .unionByName(n.select(F.lit("note").alias("kind"), F.col("n_name").alias("id"), F.col("n_name").alias("name"),
                                  F.lit("NATION").alias("label"), none.alias("text"))))
    return rows.withColumn("seq", F.lit(1))


@register("upsert_nodes_mixed", S.with_(S.STAR_ENTITIES) + """
SELECT 'node' AS kind, node_table AS a, id AS b, CASE WHEN node_table = 'NATION' THEN lower(name) ELSE name END AS c FROM star_entities
UNION ALL SELECT 'chunk', 'Chunk', 'd:' || doc_id, 'text_chunk' FROM documents
UNION ALL SELECT 'reject', 'entity', n_name, NULL FROM nation""")
def q_upsert_nodes_mixed(spark, sf):
    g, bad = merge.upsert_nodes(graphs.star_graph(spark, sf), mixed_batch(spark, sf))
    rows = snapshots.graph_rows(g).filter(F.col("kind").isin("node", "chunk"))
    return rows.unionByName(bad.select(F.lit("reject").alias("kind"), F.col("kind").alias("a"), F.col("id").alias("b"),
                                       F.lit(None).cast("string").alias("c")))


@register("upsert_triples_with_source", S.with_(S.TEXT_ENTITIES, S.TEXT_EDGES, S.TEXT_MENTIONS) + """
SELECT 'node' AS kind, node_table AS a, id AS b, name AS c FROM text_entities
UNION ALL SELECT 'chunk', 'Chunk', 'd:' || doc_id, 'text_chunk' FROM documents
UNION ALL SELECT 'edge', src, label, dst FROM text_edges
UNION ALL SELECT 'mention', chunk_id, entity_table, entity_id FROM text_mentions""")
def q_upsert_triples_with_source(spark, sf):
    base = graphs.text_graph_base(spark, sf)
    base = base.with_(chunks=base.chunks.limit(0))
    text = read_table(spark, sf, "documents", "doc_id", "text").select(prefixed_id("d:", F.col("doc_id")).alias("triplet_source_id"), "text")
    g, _ = merge.upsert_triples_with_source(base, graphs.text_relations(spark, sf).join(text, "triplet_source_id"))
    return snapshots.graph_rows(g)


def entity_batch(spark, sf) -> DataFrame:
    """Entity upserts: AUTOMOBILE customers by name (id := name), a second
    write for rich ones, and nations under a label that is not a table."""
    c = read_table(spark, sf, "customer", "c_name", "c_mktsegment", "c_acctbal").filter(
        F.col("c_mktsegment") == "AUTOMOBILE")
    n = read_table(spark, sf, "nation", "n_name")
    v1 = c.select(F.col("c_name").alias("name"), F.lit("CUSTOMER").alias("label"),
                  F.lit("crm").alias("file_name"), F.lit(1).alias("seq"))
    v2 = c.filter(F.col("c_acctbal") > 5000).select(
        F.col("c_name").alias("name"), F.lit("CUSTOMER").alias("label"), F.lit("crm2").alias("file_name"),
        F.lit(2).alias("seq"))
    bad = n.select(F.col("n_name").alias("name"), F.lit("COUNTRY").alias("label"),
                   F.lit("geo").alias("file_name"), F.lit(1).alias("seq"))
    return v1.unionByName(v2).unionByName(bad)


ENTITY_BATCH_SQL = """batch AS (
  SELECT c_name AS name, 'CUSTOMER' AS label, 'crm' AS file_name, 1 AS seq FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
  UNION ALL SELECT c_name, 'CUSTOMER', 'crm2', 2 FROM customer WHERE c_mktsegment = 'AUTOMOBILE' AND c_acctbal > 5000
  UNION ALL SELECT n_name, 'COUNTRY', 'geo', 1 FROM nation
),
routed AS (
  SELECT name AS id, name, label, file_name, seq,
         CASE WHEN label IN ('CUSTOMER', 'NATION', 'ORDER', 'PART', 'REGION', 'SUPPLIER') THEN label END AS node_table
  FROM batch
),
latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY node_table, id ORDER BY seq DESC) AS rn
           FROM routed WHERE node_table IS NOT NULL) WHERE rn = 1)"""


@register("upsert_entities", S.with_(S.STAR_ENTITIES, ENTITY_BATCH_SQL) + """
SELECT node_table, id, name, label, file_name FROM (
  SELECT node_table, id, name, label, CAST(NULL AS VARCHAR) AS file_name FROM star_entities s
  WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.node_table = s.node_table AND l.id = s.id)
  UNION ALL SELECT node_table, id, name, label, file_name FROM latest)""")
def q_upsert_entities(spark, sf):
    g, _ = merge.upsert_entities(graphs.star_graph(spark, sf), entity_batch(spark, sf))
    return g.entities.select("node_table", "id", "name", "label", "file_name")


@register("route_entity_table", S.with_(ENTITY_BATCH_SQL) + "SELECT name, label, node_table, seq FROM routed")
def q_route_entity_table(spark, sf):
    return merge.route_entities(graphs.star_graph(spark, sf), entity_batch(spark, sf)).select(
        "name", "label", "node_table", "seq")


def relation_batch(spark, sf) -> DataFrame:
    """Relation upserts: re-sourced PLACED edges (twice for big orders),
    SUPPLIES edges to the next part id (missing for the last part), a label
    outside the schema, and orders that do not exist."""
    o = read_table(spark, sf, "orders", "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    li = read_table(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_returnflag").filter(F.col("l_returnflag") == "R")
    c, k = prefixed_id("c:", F.col("o_custkey")), prefixed_id("o:", F.col("o_orderkey"))
    f = o.filter(F.col("o_orderstatus") == "F")
    parts = [
        f.select(F.lit("PLACED").alias("label"), c.alias("source_id"), k.alias("target_id"),
                 F.lit("batch1").alias("triplet_source_id"), F.lit(1).alias("seq")),
        f.filter(F.col("o_totalprice") > 100000).select(
            F.lit("PLACED").alias("label"), c.alias("source_id"), k.alias("target_id"),
            F.lit("batch2").alias("triplet_source_id"), F.lit(2).alias("seq")),
        li.select(F.lit("SUPPLIES").alias("label"), prefixed_id("s:", F.col("l_suppkey")).alias("source_id"),
                  prefixed_id("p:", F.col("l_partkey") + 1).alias("target_id"),
                  F.lit("batch1").alias("triplet_source_id"), F.lit(1).alias("seq")),
        f.select(F.lit("FRIEND_OF").alias("label"), c.alias("source_id"), c.alias("target_id"),
                 F.lit("batch1").alias("triplet_source_id"), F.lit(1).alias("seq")),
        f.select(F.lit("PLACED").alias("label"), c.alias("source_id"),
                 prefixed_id("o:", -F.col("o_orderkey")).alias("target_id"),
                 F.lit("batch1").alias("triplet_source_id"), F.lit(1).alias("seq")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


RELATION_BATCH_SQL = """rel_batch AS (
  SELECT 'PLACED' AS label, 'c:' || CAST(o_custkey AS VARCHAR) AS source_id, 'o:' || CAST(o_orderkey AS VARCHAR) AS target_id,
         'batch1' AS triplet_source_id, 1 AS seq FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT 'PLACED', 'c:' || CAST(o_custkey AS VARCHAR), 'o:' || CAST(o_orderkey AS VARCHAR), 'batch2', 2
         FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000
  UNION ALL SELECT 'SUPPLIES', 's:' || CAST(l_suppkey AS VARCHAR), 'p:' || CAST(l_partkey + 1 AS VARCHAR), 'batch1', 1
         FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT 'FRIEND_OF', 'c:' || CAST(o_custkey AS VARCHAR), 'c:' || CAST(o_custkey AS VARCHAR), 'batch1', 1
         FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT 'PLACED', 'c:' || CAST(o_custkey AS VARCHAR), 'o:' || CAST(-o_orderkey AS VARCHAR), 'batch1', 1
         FROM orders WHERE o_orderstatus = 'F'
),
star_schema(src_table, label, dst_table) AS (VALUES ('CUSTOMER', 'PLACED', 'ORDER'), ('ORDER', 'CONTAINS', 'PART'),
  ('SUPPLIER', 'SUPPLIES', 'PART'), ('CUSTOMER', 'LIVES_IN', 'NATION'), ('SUPPLIER', 'BASED_IN', 'NATION'),
  ('NATION', 'IN_REGION', 'REGION')),
resolved AS (
  SELECT s.node_table AS src_table, b.source_id AS src, s.node_table || '_' || b.label || '_' || d.node_table AS rel_table,
         b.label, d.node_table AS dst_table, b.target_id AS dst, b.triplet_source_id, b.seq
  FROM rel_batch b JOIN star_entities s ON s.id = b.source_id JOIN star_entities d ON d.id = b.target_id
  JOIN star_schema k ON k.src_table = s.node_table AND k.label = b.label AND k.dst_table = d.node_table
),
latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
             PARTITION BY src_table, src, rel_table, label, dst_table, dst ORDER BY seq DESC, triplet_source_id DESC) AS rn
           FROM resolved) WHERE rn = 1)"""


@register("upsert_edges", S.with_(S.STAR_ENTITIES, S.STAR_EDGES, RELATION_BATCH_SQL) + """
SELECT src_table, src, label, dst_table, dst, triplet_source_id FROM star_edges e
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.src_table = e.src_table AND l.src = e.src AND l.rel_table = e.rel_table
                  AND l.label = e.label AND l.dst_table = e.dst_table AND l.dst = e.dst)
UNION ALL SELECT src_table, src, label, dst_table, dst, triplet_source_id FROM latest""")
def q_upsert_edges(spark, sf):
    g, _ = merge.upsert_edges(graphs.star_graph(spark, sf), relation_batch(spark, sf))
    return g.edges.select("src_table", "src", "label", "dst_table", "dst", "triplet_source_id")


@register("edge_rejects", """
SELECT 'SUPPLIES' AS label, 's:' || l_suppkey AS source_id, 'p:' || (l_partkey + 1) AS target_id, 'batch1' AS triplet_source_id, 1 AS seq
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey + 1 LEFT JOIN supplier ON s_suppkey = l_suppkey
WHERE l_returnflag = 'R' AND (p_partkey IS NULL OR s_suppkey IS NULL)
UNION ALL SELECT 'FRIEND_OF', 'c:' || o_custkey, 'c:' || o_custkey, 'batch1', 1 FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'PLACED', 'c:' || o_custkey, 'o:' || (-o_orderkey), 'batch1', 1 FROM orders o WHERE o_orderstatus = 'F'
  AND NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_orderkey = -o.o_orderkey)
UNION ALL SELECT 'PLACED', 'c:' || o_custkey, 'o:' || o_orderkey, 'batch1', 1 FROM orders LEFT JOIN customer ON c_custkey = o_custkey
  WHERE o_orderstatus = 'F' AND c_custkey IS NULL
UNION ALL SELECT 'PLACED', 'c:' || o_custkey, 'o:' || o_orderkey, 'batch2', 2 FROM orders LEFT JOIN customer ON c_custkey = o_custkey
  WHERE o_orderstatus = 'F' AND o_totalprice > 100000 AND c_custkey IS NULL""")
def q_edge_rejects(spark, sf):
    return merge.upsert_edges(graphs.star_graph(spark, sf), relation_batch(spark, sf))[1]


@register("link_mentions", S.with_(S.TEXT_MENTIONS) + "SELECT chunk_id, entity_table, entity_id FROM text_mentions")
def q_link_mentions(spark, sf):
    return merge.link_mentions(graphs.text_graph_base(spark, sf), graphs.text_relations(spark, sf)).mentions


def _graph_rows_sql(entities: str, edges: str) -> str:
    return f"""SELECT 'node' AS kind, node_table AS a, id AS b, name AS c FROM {entities}
UNION ALL SELECT 'edge', src, label, dst FROM {edges}"""


def _delete_oracle(victims_sql: str, edge_filter: str = "TRUE") -> str:
    return S.with_(S.STAR_ENTITIES, S.STAR_EDGES) + f""",
victims AS ({victims_sql}),
ents AS (SELECT * FROM star_entities s WHERE NOT EXISTS (SELECT 1 FROM victims v WHERE v.node_table = s.node_table AND v.id = s.id)),
eds AS (SELECT * FROM star_edges e WHERE ({edge_filter})
        AND NOT EXISTS (SELECT 1 FROM victims v WHERE v.node_table = e.src_table AND v.id = e.src)
        AND NOT EXISTS (SELECT 1 FROM victims v WHERE v.node_table = e.dst_table AND v.id = e.dst))
""" + _graph_rows_sql("ents", "eds")


def _star_rows(g):
    return snapshots.graph_rows(g).filter(F.col("kind").isin("node", "edge"))


@register("delete_by_name", _delete_oracle(
    """SELECT node_table, id FROM star_entities WHERE name IN (
         SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')"""))
def q_delete_by_name(spark, sf):
    n = read_table(spark, sf, "nation", "n_name", "n_regionkey")
    r = read_table(spark, sf, "region", "r_regionkey", "r_name").filter(F.col("r_name") == "ASIA")
    names = n.join(r, n.n_regionkey == r.r_regionkey).select("n_name")
    return _star_rows(merge.delete(graphs.star_graph(spark, sf), entity_names=names))


@register("delete_by_id", _delete_oracle(
    "SELECT 'ORDER' AS node_table, 'o:' || CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderpriority = '1-URGENT'"))
def q_delete_by_id(spark, sf):
    ids = (read_table(spark, sf, "orders", "o_orderkey", "o_orderpriority")
           .filter(F.col("o_orderpriority") == "1-URGENT").select(prefixed_id("o:", F.col("o_orderkey"))))
    return _star_rows(merge.delete(graphs.star_graph(spark, sf), ids=ids))


@register("delete_by_relation", _delete_oracle(
    "SELECT NULL AS node_table, NULL AS id WHERE FALSE", "label NOT IN ('SUPPLIES', 'BASED_IN')"))
def q_delete_by_relation(spark, sf):
    return _star_rows(merge.delete(graphs.star_graph(spark, sf), relation_names=["SUPPLIES", "BASED_IN"]))


@register("delete_by_properties", _delete_oracle(
    "SELECT node_table, id FROM star_entities WHERE label = 'REGION' AND name = 'ASIA'"))
def q_delete_by_properties(spark, sf):
    return _star_rows(merge.delete(graphs.star_graph(spark, sf), properties={"label": "REGION", "name": "ASIA"}))


TRIPLE_ROWS_SQL = """SELECT 'node' AS kind, id AS a, CAST(NULL AS VARCHAR) AS b, CAST(NULL AS VARCHAR) AS c FROM nodes2
UNION ALL SELECT 'link', src, predicate, dst FROM links2"""


@register("triple_upsert", S.with_(S.CHAIN_LINKS) + """,
batch AS (
  SELECT 'n:' || CAST(n_nationkey AS VARCHAR) AS src, 'IN_REGION' AS predicate, 'r:' || CAST(n_regionkey AS VARCHAR) AS dst FROM nation
  UNION ALL SELECT 'r:' || CAST(r_regionkey AS VARCHAR), 'PART_OF', 'world' FROM region
  UNION ALL SELECT 'w:' || CAST(r_regionkey AS VARCHAR), 'SELF', 'w:' || CAST(r_regionkey AS VARCHAR) FROM region
),
links2 AS (SELECT * FROM chain_links UNION SELECT * FROM batch),
nodes2 AS (SELECT id FROM chain_nodes UNION SELECT src FROM batch UNION SELECT dst FROM batch)
""" + TRIPLE_ROWS_SQL)
def q_triple_upsert(spark, sf):
    n = read_table(spark, sf, "nation", "n_nationkey", "n_regionkey")
    r = read_table(spark, sf, "region", "r_regionkey")
    batch = (n.select(prefixed_id("n:", F.col("n_nationkey")).alias("src"), F.lit("IN_REGION").alias("predicate"),
                      prefixed_id("r:", F.col("n_regionkey")).alias("dst"))
             .unionByName(r.select(prefixed_id("r:", F.col("r_regionkey")).alias("src"),
                                   F.lit("PART_OF").alias("predicate"), F.lit("world").alias("dst")))
             .unionByName(r.select(prefixed_id("w:", F.col("r_regionkey")).alias("src"),
                                   F.lit("SELF").alias("predicate"), prefixed_id("w:", F.col("r_regionkey")).alias("dst"))))
    return snapshots.triple_rows(merge.triple_upsert(graphs.chain_graph(spark, sf), batch))


@register("triple_delete", S.with_(S.CHAIN_LINKS) + """,
dead AS (
  SELECT 'n:' || CAST(n_nationkey AS VARCHAR) AS src, 'IN_REGION' AS predicate, 'r:' || CAST(n_regionkey AS VARCHAR) AS dst
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'
  UNION ALL SELECT 'r:' || CAST(r_regionkey AS VARCHAR), 'NOPE', 'n:' || CAST(r_regionkey AS VARCHAR) FROM region
),
links2 AS (SELECT * FROM chain_links l WHERE NOT EXISTS (
  SELECT 1 FROM dead d WHERE d.src = l.src AND d.predicate = l.predicate AND d.dst = l.dst)),
named AS (SELECT src AS id FROM dead UNION SELECT dst FROM dead),
orphans AS (SELECT id FROM named WHERE id NOT IN (SELECT src FROM links2 UNION SELECT dst FROM links2)),
nodes2 AS (SELECT id FROM chain_nodes WHERE id NOT IN (SELECT id FROM orphans))
""" + TRIPLE_ROWS_SQL)
def q_triple_delete(spark, sf):
    n = read_table(spark, sf, "nation", "n_nationkey", "n_regionkey")
    r = read_table(spark, sf, "region", "r_regionkey", "r_name")
    asia = n.join(r.filter(F.col("r_name") == "ASIA"), n.n_regionkey == r.r_regionkey)
    dead = (asia.select(prefixed_id("n:", F.col("n_nationkey")).alias("src"), F.lit("IN_REGION").alias("predicate"),
                        prefixed_id("r:", F.col("n_regionkey")).alias("dst"))
            .unionByName(r.select(prefixed_id("r:", F.col("r_regionkey")).alias("src"), F.lit("NOPE").alias("predicate"),
                                  prefixed_id("n:", F.col("r_regionkey")).alias("dst"))))
    return snapshots.triple_rows(merge.triple_delete(graphs.chain_graph(spark, sf), dead))


# A1-A7 loads and snapshots -------------------------------------------------------

@register("entities_load", S.with_(S.STAR_ENTITIES) + "SELECT node_table, id, name, label FROM star_entities")
def q_entities_load(spark, sf):
    return graphs.star_graph(spark, sf).entities.select("node_table", "id", "name", "label")


@register("edges_load", S.with_(S.STAR_EDGES) +
          "SELECT src_table, src, rel_table, label, dst_table, dst, triplet_source_id FROM star_edges")
def q_edges_load(spark, sf):
    return graphs.star_graph(spark, sf).edges


@register("chunks_load", S.with_(S.TEXT_CHUNKS) + """
SELECT id, text, label, CAST(len(embedding) AS INTEGER) AS n_dims, file_name, file_path, file_size, file_type, ref_doc_id FROM text_chunks""")
def q_chunks_load(spark, sf):
    c = graphs.text_graph(spark, sf).chunks
    return c.select("id", "text", "label", F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("n_dims"),
                    "file_name", "file_path", "file_size", "file_type", "ref_doc_id")


@register("triples_load", S.with_(S.WEB_LINKS) + """
SELECT 'node' AS kind, id AS a, CAST(NULL AS VARCHAR) AS b, CAST(NULL AS VARCHAR) AS c FROM web_nodes
UNION ALL SELECT 'link', src, predicate, dst FROM web_links""")
def q_triples_load(spark, sf):
    return snapshots.triple_rows(graphs.web_graph(spark, sf))


@register("snapshot_roundtrip", S.with_(S.STAR_ENTITIES, S.STAR_EDGES) + _graph_rows_sql("star_entities", "star_edges"))
def q_snapshot_roundtrip(spark, sf):
    root = scratch_path(spark, "snapshot")
    snapshots.write_graph(graphs.star_graph(spark, sf), root)
    return _star_rows(snapshots.read_graph(spark, root))


@register("triples_roundtrip", S.with_(S.CHAIN_LINKS) + """
SELECT 'node' AS kind, id AS a, CAST(NULL AS VARCHAR) AS b, CAST(NULL AS VARCHAR) AS c FROM (
  SELECT id FROM chain_nodes UNION SELECT 'r:' || r_regionkey FROM region UNION SELECT 'world')
UNION ALL SELECT 'link', src, predicate, dst FROM chain_links
UNION ALL SELECT 'link', 'r:' || r_regionkey, '', 'world' FROM region
UNION ALL SELECT 'link', 'r:' || r_regionkey, NULL, 'world' FROM region""")
def q_triples_roundtrip(spark, sf):
    """Links with an empty and with a NULL predicate survive a reopening."""
    r = read_table(spark, sf, "region", "r_regionkey")
    odd = [r.select(prefixed_id("r:", F.col("r_regionkey")).alias("src"), F.lit(p).cast("string").alias("predicate"),
                    F.lit("world").alias("dst")) for p in ("", None)]
    root = scratch_path(spark, "triples")
    snapshots.write_triples(merge.triple_upsert(graphs.chain_graph(spark, sf), odd[0].unionByName(odd[1])), root)
    return snapshots.triple_rows(snapshots.read_triples(spark, root))


def _sizes(g, stage: str) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(stage).alias("stage"), F.lit(kind).alias("kind"), "n")
             for kind, df in (("node", g.entities), ("edge", g.edges))]
    return parts[0].unionByName(parts[1])


@register("clear_all", S.with_(S.STAR_ENTITIES, S.STAR_EDGES) + """
SELECT 'before' AS stage, 'node' AS kind, count(*) AS n FROM star_entities
UNION ALL SELECT 'before', 'edge', count(*) FROM star_edges
UNION ALL SELECT 'after', 'node', 0 UNION ALL SELECT 'after', 'edge', 0""")
def q_clear_all(spark, sf):
    root = scratch_path(spark, "clear")
    snapshots.write_graph(graphs.star_graph(spark, sf), root)
    before = snapshots.read_graph(spark, root)
    snapshots.write_graph(merge.clear(before), root)
    return _sizes(before, "before").unionByName(_sizes(snapshots.read_graph(spark, root), "after"))


# V1-V8 vector search ---------------------------------------------------------------

from quiver.operators import cells, retrieve, vector  # noqa: E402

VEC_DIM = graphs.EMBED_DIM


def label_centroids(spark, sf) -> DataFrame:
    """One query vector per embedding label: the mean of that label's vectors."""
    emb = read_table(spark, sf, "embeddings", "label", "embedding")
    return vector.centroids_by(emb, "label", dim=VEC_DIM).select(F.col("label").alias("qid"), "vec")


def label_query(spark, sf, label: int = 1) -> list[float]:
    """The label's centroid as a driver-side vector (dimension-sized)."""
    emb = read_table(spark, sf, "embeddings", "label", "embedding").filter(F.col("label") == label)
    return list(vector.centroids_by(emb, "label", dim=VEC_DIM).collect()[0]["vec"])


CENTROIDS_SQL = """centroids AS (
  SELECT label AS qid, list(x ORDER BY pos) AS vec FROM (
    SELECT label, pos, avg(x) AS x FROM (
      SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(generate_series(1, len(embedding))) AS pos
      FROM embeddings WHERE embedding IS NOT NULL)
    GROUP BY label, pos)
  GROUP BY label
),
vec_chunks AS (SELECT id, text, embedding FROM text_chunks WHERE embedding IS NOT NULL AND len(embedding) = 64)"""


def _topk_sql(k: int = 5) -> str:
    return S.with_(S.TEXT_CHUNKS, CENTROIDS_SQL) + f"""
SELECT id, CAST(row_number() OVER (ORDER BY sim DESC, id) AS INTEGER) AS rank, round(sim, 6) AS similarity
FROM (SELECT id, list_cosine_similarity(embedding, (SELECT vec FROM centroids WHERE qid = 1)) AS sim FROM vec_chunks)
ORDER BY sim DESC, id LIMIT {k}"""


def _ranked(df: DataFrame) -> DataFrame:
    return df.select("id", F.col("rank").cast("int").alias("rank"), F.round("similarity", 6).alias("similarity"))


@register("vector_topk", _topk_sql(5))
def q_vector_topk(spark, sf):
    chunks = graphs.text_chunks(spark, sf)
    return _ranked(vector.topk(chunks, label_query(spark, sf), 5, VEC_DIM))


@register("vector_topk_batch", S.with_(S.TEXT_CHUNKS, CENTROIDS_SQL) + """
SELECT qid, id, CAST(rank AS INTEGER) AS rank, round(sim, 6) AS similarity FROM (
  SELECT c.qid, v.id, list_cosine_similarity(v.embedding, c.vec) AS sim,
         row_number() OVER (PARTITION BY c.qid ORDER BY list_cosine_similarity(v.embedding, c.vec) DESC, v.id) AS rank
  FROM vec_chunks v, centroids c) WHERE rank <= 5""")
def q_vector_topk_batch(spark, sf):
    out = vector.topk_batch(graphs.text_chunks(spark, sf), label_centroids(spark, sf), 5, VEC_DIM)
    return out.select(F.col("qid").cast("int").alias("qid"), "id", F.col("rank").cast("int").alias("rank"),
                      F.round("similarity", 6).alias("similarity"))


@register("cosine_pairs", S.with_(S.TEXT_CHUNKS, CENTROIDS_SQL) + """
SELECT v.id, e.label, round(list_cosine_similarity(v.embedding, c.vec), 6) AS similarity,
       round(1.0 - list_cosine_similarity(v.embedding, c.vec), 6) AS distance
FROM vec_chunks v JOIN embeddings e ON v.id = 'd:' || CAST(e.vec_id AS VARCHAR) JOIN centroids c ON c.qid = e.label""")
def q_cosine_pairs(spark, sf):
    chunks = graphs.text_chunks(spark, sf)
    lab = read_table(spark, sf, "embeddings", "vec_id", "label").select(
        prefixed_id("d:", F.col("vec_id")).alias("id"), "label")
    cents = label_centroids(spark, sf).withColumnRenamed("qid", "label")
    sim = vector.similarity_to_group_centroid(chunks.drop("label").join(lab, "id"), cents, "label")
    return sim.select("id", "label", F.round("similarity", 6).alias("similarity"),
                      F.round(F.lit(1.0) - F.col("similarity"), 6).alias("distance"))


@register("embedding_dims", S.with_(S.TEXT_CHUNKS) + "SELECT CAST(len(embedding) AS INTEGER) AS dims, count(*) AS n FROM text_chunks GROUP BY 1")
def q_embedding_dims(spark, sf):
    return vector.embedding_dims(graphs.text_chunks(spark, sf))


@register("choose_dimension", S.with_(S.TEXT_CHUNKS) + """
SELECT 'stored' AS case_, CAST(mode(len(embedding)) AS INTEGER) AS dim FROM text_chunks WHERE embedding IS NOT NULL
UNION ALL SELECT 'given', 384 UNION ALL SELECT 'unknown', NULL""")
def q_choose_dimension(spark, sf):
    """Detected before given before unknown."""
    c = graphs.text_chunks(spark, sf)
    bare = c.filter(F.col("embedding").isNull())
    rows = [("stored", vector.choose_dimension(c, 384)), ("given", vector.choose_dimension(bare, 384)), ("unknown", vector.choose_dimension(bare))]
    return spark.createDataFrame(rows, "case_ string, dim int")


def _index_root(spark, sf: str) -> str:
    import hashlib
    return f"{checkpoint_root(spark)}/quiver/cells/{hashlib.sha1(sf.encode()).hexdigest()[:16]}"


def _index(spark, sf):
    """The index of the text chunks as the tables' files are now, kept under
    the checkpoint folder and reused while they stay."""
    state = table_state(spark, sf, "documents", "embeddings")
    return cells.ensure(graphs.text_chunks(spark, sf), _index_root(spark, sf), VEC_DIM, state)


@register("vector_query", _topk_sql(5))
def q_vector_query(spark, sf):
    """One call: makes the index current, then searches it exactly."""
    state = table_state(spark, sf, "documents", "embeddings")
    return _ranked(retrieve.vector_query(graphs.text_graph(spark, sf), label_query(spark, sf), _index_root(spark, sf), 5, state=state))


@register("ivf_topk", _topk_sql(5))
def q_ivf_topk(spark, sf):
    idx = _index(spark, sf)
    return _ranked(cells.search(spark, idx, label_query(spark, sf), 5))


@register("ivf_topk_pruned", f"""
SELECT *, TRUE AS cells_counted FROM ({_topk_sql(5)})""")
def q_ivf_topk_pruned(spark, sf):
    """The bounded search equals the full scan; the cells and rows it read are
    counted, and are no more than there are."""
    idx, q = _index(spark, sf), label_query(spark, sf)
    hits, n = cells.search_counted(spark, idx, q, 5)
    return _ranked(hits).withColumn("cells_counted", F.lit(0 < n["cells"] <= n["all_cells"] and 5 <= n["rows"] <= n["all_rows"]))


@register("ivf_build", S.with_(S.TEXT_CHUNKS, CENTROIDS_SQL) + """
SELECT count(*) AS n_valid, count(*) AS n_indexed, 0::BIGINT AS n_misplaced, TRUE AS reused FROM vec_chunks""")
def q_ivf_build(spark, sf):
    """Every valid vector is in the layout, in the nearest cell of its coarse
    cell and inside its radius, and a second call on the same tables reuses it."""
    idx, again = _index(spark, sf), _index(spark, sf)
    ids = graphs.text_chunks(spark, sf).filter(vector.valid_vector(F.col("embedding"), VEC_DIM)).select("id")
    lay = idx.rows(spark).select("id", F.lit(1).alias("h"))
    bad = cells.misplaced(idx, spark).select("id", F.lit(1).alias("b"))
    return ids.join(lay, "id", "full").join(bad, "id", "left").agg(
        F.count(F.lit(1)).alias("n_valid"), F.sum(F.coalesce("h", F.lit(0))).alias("n_indexed"), F.count("b").alias("n_misplaced")).withColumn(
        "reused", F.lit(idx.version == again.version))


@register("ivf_recall", S.with_(S.TEXT_CHUNKS, CENTROIDS_SQL) + """
SELECT count(*) AS n_queries, 5 * count(*) AS n_exact, TRUE AS recall_reached FROM vec_chunks
WHERE CAST(substr(id, 3) AS BIGINT) % 100 = 0""")
def q_ivf_recall(spark, sf):
    """Probing the calibrated number of cells for every vector whose id is
    divisible by 100 finds at least 0.9 of what the exact search finds."""
    idx = _index(spark, sf)
    chunks = graphs.text_chunks(spark, sf)
    queries = materialize(chunks.filter(vector.valid_vector(F.col("embedding"), VEC_DIM) & (F.col("ref_doc_id").cast("long") % 100 == 0))
                          .select(F.col("id").alias("qid"), F.col("embedding").alias("vec")))
    found = vector.recall(cells.probe_batch(spark, idx, queries, 5), vector.topk_batch(chunks, queries, 5, VEC_DIM))
    return found.select(F.lit(queries.count()).cast("long").alias("n_queries"), "n_exact", (F.col("recall") >= 0.9).alias("recall_reached"))


@register("ivf_refresh", S.with_(S.TEXT_CHUNKS, CENTROIDS_SQL) + """
SELECT 'q:new' AS id, 1 AS rank, 1.0::DOUBLE AS similarity, 1::BIGINT AS n_rewritten,
       (SELECT count(*) + 1 FROM vec_chunks WHERE id NOT IN (SELECT 'd:' || doc_id FROM documents WHERE source = 'src3')) AS n_indexed""")
def q_ivf_refresh(spark, sf):
    """After an upsert (src3 loses its vectors, a chunk equal to the query is
    new) the refresh writes the one new row, marks the others as gone, and the
    search finds the new chunk."""
    root = scratch_path(spark, "index-refresh")
    g = graphs.text_graph(spark, sf)
    first = cells.build(g.chunks, root, VEC_DIM)
    q = label_query(spark, sf)
    new = spark.createDataFrame([("q:new", "new", q, 9)], "id string, text string, embedding array<double>, seq int")
    g2, _ = merge.upsert_chunks(g, chunk_batch(spark, sf))
    g2, _ = merge.upsert_chunks(g2, new)
    fresh = cells.refresh(first, g2.chunks, drift=2.0)
    live = fresh.rows(spark).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    return _ranked(cells.search(spark, fresh, q, 1)).withColumns({"n_rewritten": F.lit(fresh.rewritten).cast("long"), "n_indexed": F.lit(live).cast("long")})


# A8-A12 ingest ---------------------------------------------------------------------

from quiver.operators import ingest  # noqa: E402
from quiver.sources import files  # noqa: E402

CHUNKS_SQL = """sents AS (
  SELECT doc_id, t.i AS s_pos, list_filter(string_split_regex(t.s, '\\s+'), lambda w: w <> '') AS w
  FROM (SELECT doc_id, unnest(list_transform(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)),
                                             lambda x, i: {'s': x, 'i': i})) AS t FROM documents)
),
pieces AS (
  SELECT doc_id, s_pos, p, list_slice(w, p * 512 + 1, (p + 1) * 512) AS pw
  FROM (SELECT doc_id, s_pos, w, unnest(range(0, CAST(ceil(len(w) / 512.0) AS BIGINT))) AS p FROM sents WHERE len(w) > 0)
),
pk AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s_pos, p) AS rn, len(pw) AS nw, pw FROM pieces),
rec(doc_id, rn, chunk_no, cur) AS (
  SELECT doc_id, rn, 0, nw FROM pk WHERE rn = 1
  UNION ALL
  SELECT p.doc_id, p.rn, CASE WHEN r.cur > 0 AND r.cur + p.nw > 512 THEN r.chunk_no + 1 ELSE r.chunk_no END,
         CASE WHEN r.cur > 0 AND r.cur + p.nw > 512 THEN p.nw ELSE r.cur + p.nw END
  FROM rec r JOIN pk p ON p.doc_id = r.doc_id AND p.rn = r.rn + 1
)"""


@register("chunk_documents", "WITH RECURSIVE " + CHUNKS_SQL + """
SELECT r.doc_id, CAST(r.chunk_no AS INTEGER) AS chunk_no, CAST(sum(p.nw) AS INTEGER) AS n_words,
       string_agg(array_to_string(p.pw, ' '), ' ' ORDER BY r.rn) AS text
FROM rec r JOIN pk p ON p.doc_id = r.doc_id AND p.rn = r.rn GROUP BY r.doc_id, r.chunk_no""")
def q_chunk_documents(spark, sf):
    docs = read_table(spark, sf, "documents", "doc_id", "text")
    return ingest.chunk_documents(docs)


def _split_sql(size: int, overlap: int) -> str:
    return f"""paras AS (
  SELECT doc_id, unnest(list_transform(string_split_regex(text, '\\n\\s*\\n'), lambda x, i: {{'p': x, 'i': i}})) AS t FROM documents
),
units AS (
  SELECT doc_id, t.i AS p_pos, unnest(CASE WHEN len(list_filter(string_split_regex(t.p, '\\s+'), lambda w: w <> '')) <= {size}
      THEN [{{'s': t.p, 'i': CAST(1 AS BIGINT)}}]
      ELSE list_transform(string_split(regexp_replace(t.p, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x, i: {{'s': x, 'i': i}}) END) AS u
  FROM paras
),
uw AS (SELECT doc_id, p_pos, u.i AS s_pos, list_filter(string_split_regex(u.s, '\\s+'), lambda w: w <> '') AS w FROM units),
pieces AS (
  SELECT doc_id, p_pos, s_pos, k, list_slice(w, k * {size} + 1, (k + 1) * {size}) AS pw
  FROM (SELECT *, unnest(range(0, CAST(ceil(len(w) / {size}.0) AS BIGINT))) AS k FROM uw WHERE len(w) > 0)
),
pk AS (SELECT doc_id, row_number() OVER d AS rn, len(pw) AS nw, pw, sum(len(pw)) OVER d AS upto FROM pieces
       WINDOW d AS (PARTITION BY doc_id ORDER BY p_pos, s_pos, k)),
sums AS (SELECT doc_id, list_prepend(0, list(upto ORDER BY rn)) AS t FROM pk GROUP BY doc_id),
rec(doc_id, rn, chunk_no, first, again) AS (
  SELECT doc_id, rn, 0, rn, CAST(0 AS HUGEINT) FROM pk WHERE rn = 1
  UNION ALL
  SELECT doc_id, rn, chunk_no, first, CASE WHEN first = old_first AND chunk_no = old_no THEN again ELSE t[rn] - t[first] END FROM (
    SELECT r.doc_id, p.rn, r.chunk_no AS old_no, r.first AS old_first, r.again, s.t,
           CASE WHEN p.upto - s.t[r.first] > {size} THEN r.chunk_no + 1 ELSE r.chunk_no END AS chunk_no,
           CASE WHEN p.upto - s.t[r.first] > {size}
                THEN list_filter(range(r.first, p.rn + 1), lambda j: s.t[p.rn] - s.t[j] <= least({overlap}, {size} - p.nw))[1]
                ELSE r.first END AS first
    FROM rec r JOIN pk p ON p.doc_id = r.doc_id AND p.rn = r.rn + 1 JOIN sums s ON s.doc_id = r.doc_id)
),
spans AS (SELECT doc_id, chunk_no, any_value(first) AS first, max(rn) AS last, any_value(again) AS again FROM rec GROUP BY doc_id, chunk_no)
SELECT s.doc_id, CAST(s.chunk_no AS INTEGER) AS chunk_no, CAST(sum(p.nw) AS INTEGER) AS n_words,
       CAST(any_value(s.again) AS INTEGER) AS n_overlap, string_agg(array_to_string(p.pw, ' '), ' ' ORDER BY p.rn) AS text
FROM spans s JOIN pk p ON p.doc_id = s.doc_id AND p.rn BETWEEN s.first AND s.last GROUP BY s.doc_id, s.chunk_no"""


@register("split_documents", "WITH RECURSIVE " + _split_sql(128, 50))
def q_split_documents(spark, sf):
    return ingest.split_documents(read_table(spark, sf, "documents", "doc_id", "text"), size=128, overlap=50)


@register("split_documents_plain", "WITH RECURSIVE " + _split_sql(128, 0))
def q_split_documents_plain(spark, sf):
    return ingest.split_documents(read_table(spark, sf, "documents", "doc_id", "text"), size=128)


@register("embed_chunks", """
WITH w AS (SELECT 'd:' || doc_id AS id, unnest(list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '')) AS w FROM documents),
h AS (SELECT id, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 128 AS c FROM w),
v AS (SELECT id, c // 2 AS pos, sum(CASE WHEN c % 2 = 0 THEN 1.0 ELSE -1.0 END) AS x FROM h GROUP BY ALL),
n AS (SELECT id, sqrt(sum(x * x)) AS n FROM v GROUP BY id),
g AS (SELECT n.id, n.n, CAST(p AS BIGINT) AS pos FROM n, range(64) t(p) WHERE n.n > 0)
SELECT g.id, CAST(g.pos AS INTEGER) AS pos, round(coalesce(v.x, 0.0) / g.n, 6) AS x FROM g LEFT JOIN v ON v.id = g.id AND v.pos = g.pos""")
def q_embed_chunks(spark, sf):
    chunks = graphs.text_chunks(spark, sf).select("id", "text")
    e = ingest.embed_chunks(chunks, dim=VEC_DIM)
    # not posexplode: the filter Spark infers for it (not NULL, not empty) would make each embedding two times more
    places = e.select("id", F.posexplode_outer("embedding").alias("pos", "x")).filter("pos IS NOT NULL")
    return places.withColumn("x", F.round("x", 6))


def href_extractor(batches):
    """A plugged-in extractor: each href of a page is a triple; its target is
    a PAGE if absolute, else a PATH."""
    import re

    import pandas as pd
    for b in batches:
        rows = [(i, i, "PAGE", "LINKS_TO", h, "PAGE" if h.startswith("http") else "PATH")
                for i, t in zip(b["id"], b["text"]) if t for h in re.findall(graphs.HREF_PATTERN, t)]
        yield pd.DataFrame(rows, columns=["triplet_source_id", "head", "head_label", "label", "tail", "tail_label"])


@register("extract_triples_strict", """
SELECT url AS head, 'LINKS_TO' AS label, h AS tail, h LIKE 'http%' AS accepted FROM (
  SELECT url, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS h FROM pages)""")
def q_extract_triples_strict(spark, sf):
    pages = read_table(spark, sf, "pages", "url", "html").select(F.col("url").alias("id"), F.col("html").alias("text"))
    good, bad = ingest.extract_triples(pages, href_extractor, schema=[("PAGE", "LINKS_TO", "PAGE")])
    cols = ["head", "label", "tail"]
    return (good.select(*cols, F.lit(True).alias("accepted")).unionByName(bad.select(*cols, F.lit(False).alias("accepted"))))


@register("extract_link_triples", S.with_(S.WEB_LINKS) + "SELECT src, predicate, dst FROM web_links")
def q_extract_link_triples(spark, sf):
    return ingest.extract_links(read_table(spark, sf, "pages", "url", "html"), graphs.HREF_PATTERN)


@register("cap_triples_per_chunk", """
WITH h AS (
  SELECT page_id, t.h AS dst, min(t.i) AS first_pos FROM (
    SELECT page_id, unnest(list_transform(regexp_extract_all(html, 'href="([^"]+)"', 1), lambda x, i: {'h': x, 'i': i})) AS t
    FROM pages) GROUP BY page_id, t.h
)
SELECT page_id, CAST(pos AS INTEGER) AS pos, dst FROM (
  SELECT page_id, dst, row_number() OVER (PARTITION BY page_id ORDER BY first_pos) AS pos FROM h) WHERE pos <= 2""")
def q_cap_triples_per_chunk(spark, sf):
    out = ingest.cap_links_per_chunk(read_table(spark, sf, "pages", "page_id", "html"), graphs.HREF_PATTERN, 2)
    return out.select("page_id", F.col("pos").cast("int").alias("pos"), "dst")


@register("files_to_documents", """
SELECT doc_id, text, lang, 'application/json' AS file_type, TRUE AS has_file FROM documents""")
def q_files_to_documents(spark, sf):
    path = scratch_path(spark, "docs-json")
    docs = read_table(spark, sf, "documents", "doc_id", "text", "lang")
    docs.write.mode("overwrite").partitionBy("lang").json(path)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType())])
    d = files.read_json_documents(spark, path, schema)
    return d.select("doc_id", "text", "lang", "file_type",
                    (F.col("file_name").isNotNull() & (F.col("file_size") > 0)).alias("has_file"))


@register("text_files_to_documents", """
SELECT source, count(DISTINCT source) AS n_files, CAST(sum(length(text) + 1) AS BIGINT) AS n_chars, 'text/plain' AS file_type, TRUE AS dated
FROM documents GROUP BY source""")
def q_text_files_to_documents(spark, sf):
    """Whole-file reading: one text file per source, read back as documents."""
    path = scratch_path(spark, "docs-text")
    docs = read_table(spark, sf, "documents", "source", "text")
    docs.repartition("source").write.mode("overwrite").partitionBy("source").text(path)
    d = files.read_text_files(spark, path)
    return (d.withColumn("source", F.regexp_extract("file_path", "source=([^/]+)", 1)).groupBy("source", "file_type")
            .agg(F.count(F.lit(1)).alias("n_files"), F.sum(F.length("text")).cast("long").alias("n_chars"),
                 F.bool_and(F.col("creation_date").isNotNull() & F.col("last_modified_date").isNotNull()).alias("dated")))


@register("export_edge_list", S.with_(S.STAR_EDGES) + "SELECT src, label, dst FROM star_edges")
def q_export_edge_list(spark, sf):
    path = scratch_path(spark, "edge-list")
    files.export_edge_list(graphs.star_graph(spark, sf).edges, path, "csv")
    return files.read_edge_list(spark, path, "csv")


@register("export_graph", S.with_(S.STAR_ENTITIES, S.STAR_EDGES) + """
SELECT 'node' AS kind, node_table AS a_table, id AS a, name AS name, label, NULL AS b_table, NULL AS b FROM star_entities
UNION ALL SELECT 'edge', src_table, src, NULL, label, dst_table, dst FROM star_edges""")
def q_export_graph(spark, sf):
    """Nodes and edges read back from the export."""
    path = scratch_path(spark, "graph-export")
    files.export_graph(graphs.star_graph(spark, sf), path, "csv")
    nodes, edges = files.read_graph_export(spark, path, "csv")
    null = F.lit(None).cast("string")
    return nodes.select(F.lit("node").alias("kind"), F.col("node_table").alias("a_table"), F.col("id").alias("a"), "name", "label",
                        null.alias("b_table"), null.alias("b")).unionByName(
        edges.select(F.lit("edge").alias("kind"), F.col("src_table").alias("a_table"), F.col("src").alias("a"), null.alias("name"), "label",
                     F.col("dst_table").alias("b_table"), F.col("dst").alias("b")))


# R1-R6 retrieval -------------------------------------------------------------------

from quiver.operators import retrieve  # noqa: E402

_TEXT_ALL = (S.TEXT_CHUNKS, S.TEXT_ENTITIES, S.TEXT_EDGES, S.TEXT_MENTIONS, CENTROIDS_SQL)

HITS_SQL = """hits AS (
  SELECT id, text, sim, row_number() OVER (ORDER BY sim DESC, id) AS rank FROM (
    SELECT id, text, list_cosine_similarity(embedding, (SELECT vec FROM centroids WHERE qid = 1)) AS sim FROM vec_chunks)
  ORDER BY sim DESC, id LIMIT 5
)"""

HIT_ENTITIES_SQL = """hit_entities AS (
  SELECT m.chunk_id, m.entity_table, m.entity_id, e.name FROM text_mentions m
  JOIN text_entities e ON e.node_table = m.entity_table AND e.id = m.entity_id
  WHERE m.chunk_id IN (SELECT id FROM hits)
)"""


@register("entities_of_chunks", S.with_(*_TEXT_ALL, HITS_SQL, HIT_ENTITIES_SQL) +
          "SELECT chunk_id, entity_table, entity_id, name FROM hit_entities")
def q_entities_of_chunks(spark, sf):
    g = graphs.text_graph(spark, sf)
    hits = vector.topk(g.chunks, label_query(spark, sf), 5, VEC_DIM)
    return retrieve.entities_of_chunks(g, hits)


_HYBRID_SEEDS = """seeds AS (
  SELECT n.node_table AS start_table, n.id AS start FROM (
    SELECT node_table, id FROM text_entities UNION ALL SELECT 'Chunk', id FROM text_chunks) n
  WHERE n.id IN (SELECT entity_id FROM hit_entities))"""


def _hybrid_sql() -> str:
    base = _paths_oracle(_HYBRID_SEEDS, 2, 30, edges="text_edges", extra=(*_TEXT_ALL, HITS_SQL, HIT_ENTITIES_SQL))
    trip = " UNION ALL ".join(
        f"SELECT path, {k} AS hop, s{k}t AS st, s{k} AS src, l{k} AS label, d{k}t AS dt, d{k} AS dst, t{k} AS tsid "
        f"FROM paths WHERE hops >= {k}" for k in (1, 2))
    return base + f""",
trip AS ({trip}),
named AS (SELECT t.*, sn.name AS src_name, dn.name AS dst_name FROM trip t
          LEFT JOIN text_entities sn ON sn.node_table = t.st AND sn.id = t.src
          LEFT JOIN text_entities dn ON dn.node_table = t.dt AND dn.id = t.dst),
g AS (SELECT tsid AS node_id, 1 AS origin_rank, row_number() OVER (ORDER BY path, hop) AS pos,
             CAST(NULL AS DOUBLE) AS score, concat_ws(' ', src_name, label, dst_name) AS text
      FROM named WHERE tsid IS NOT NULL),
v AS (SELECT id AS node_id, 0 AS origin_rank, rank AS pos, sim AS score, text FROM hits),
both_ AS (SELECT * FROM v UNION ALL SELECT * FROM g)
SELECT node_id, CASE WHEN origin_rank = 0 THEN 'vector' ELSE 'graph' END AS origin, pos, round(score, 6) AS score, text
FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY origin_rank, pos) AS rn FROM both_) WHERE rn = 1"""


def _hybrid(spark, sf_dir):
    g = graphs.text_graph(spark, sf_dir)
    out = retrieve.hybrid_retrieve(g, label_query(spark, sf_dir), 5, 2, 30)
    return out.select("node_id", "origin", "pos", F.round("score", 6).alias("score"), "text")


register("hybrid_retrieve", _hybrid_sql())(_hybrid)


def keyword_frame(spark, sf) -> DataFrame:
    """Keywords: nations of AMERICA and suppliers in debt, lower-cased."""
    n = read_table(spark, sf, "nation", "n_name", "n_regionkey")
    r = read_table(spark, sf, "region", "r_regionkey", "r_name").filter(F.col("r_name") == "AMERICA")
    s = read_table(spark, sf, "supplier", "s_name", "s_acctbal").filter(F.col("s_acctbal") < 0)
    return (n.join(r, n.n_regionkey == r.r_regionkey).select(F.lower("n_name").alias("kw"))
            .unionByName(s.select(F.lower("s_name").alias("kw"))))


_KW_SEEDS = """seeds AS (SELECT node_table AS start_table, id AS start FROM star_entities WHERE lower(name) IN (
  SELECT lower(n_name) FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'AMERICA'
  UNION SELECT lower(s_name) FROM supplier WHERE s_acctbal < 0))"""


_TYPOS = """
SELECT substr(n_name, 1, 1) || substr(n_name, 3) || 'x' AS kw FROM {nation}
UNION ALL SELECT replace(lower(s_name), '0000', '000') FROM {supplier}
UNION ALL SELECT substr(r_name, 2) FROM {region}"""
_TYPOS_SQL = "typos AS (" + _TYPOS.replace("{", "").replace("}", "") + ")"


@register("keyword_fuzzy", S.with_(S.STAR_ENTITIES, _TYPOS_SQL) + """
SELECT DISTINCT lower(kw) AS keyword, node_table, id, lower(name) AS name, CAST(levenshtein(lower(name), lower(kw)) AS INTEGER) AS distance
FROM star_entities, typos WHERE abs(length(name) - length(kw)) <= 2 AND levenshtein(lower(name), lower(kw)) <= 2""")
def q_keyword_fuzzy(spark, sf):
    """Entities whose names are within two edits of misspelt keywords."""
    typos = spark.sql(_TYPOS, **{t: read_table(spark, sf, t) for t in ("nation", "supplier", "region")})
    return retrieve.keyword_matches(graphs.star_graph(spark, sf), typos, 2)


@register("keyword_retrieve", _paths_oracle(_KW_SEEDS, 2, 30) + _hops_sql(2))
def q_keyword_retrieve(spark, sf):
    return retrieve.keyword_retrieve(graphs.star_graph(spark, sf), keyword_frame(spark, sf), 2, 30)


TEXT_TRIPLETS_SQL = """text_triplets AS (
  SELECT e.src_table, e.src, s.name AS src_name, e.label, e.dst_table, e.dst, d.name AS dst_name, e.triplet_source_id
  FROM text_edges e JOIN text_entities s ON s.node_table = e.src_table AND s.id = e.src
  JOIN text_entities d ON d.node_table = e.dst_table AND d.id = e.dst
  WHERE s.label IS NOT NULL AND s.label <> 'text_chunk'
)"""


@register("triplets_with_text", S.with_(*_TEXT_ALL, TEXT_TRIPLETS_SQL) + """
SELECT t.src, t.label, t.dst, t.triplet_source_id, c.text AS source_text
FROM (SELECT * FROM text_triplets ORDER BY src, label, dst, src_table, dst_table LIMIT 100) t
LEFT JOIN text_chunks c ON c.id = t.triplet_source_id""")
def q_triplets_with_text(spark, sf):
    g = graphs.text_graph(spark, sf)
    return retrieve.with_source_text(g, lookup.triplets(g)).select(
        "src", "label", "dst", "triplet_source_id", "source_text")


def spanish_long_sources(spark, sf) -> DataFrame:
    d = read_table(spark, sf, "documents", "source", "lang", "n_chars")
    return d.filter((F.col("lang") == "es") & (F.col("n_chars") > 5000)).select(F.col("source").alias("name")).distinct()


@register("hybrid_triplets", S.with_(*_TEXT_ALL, TEXT_TRIPLETS_SQL) + """
SELECT DISTINCT src, label, dst FROM (
  SELECT * FROM (
    SELECT t.src, t.label, t.dst, list_cosine_similarity(c.embedding, (SELECT vec FROM centroids WHERE qid = 1)) AS sim
    FROM text_triplets t JOIN vec_chunks c ON c.id = t.triplet_source_id
    ORDER BY sim DESC, src, label, dst LIMIT 5)
  UNION ALL
  SELECT * FROM (SELECT src, label, dst, NULL FROM text_triplets
                 WHERE src_name IN (SELECT source FROM documents WHERE lang = 'es' AND n_chars > 5000)
                 ORDER BY src, label, dst, src_table, dst_table LIMIT 100))""")
def q_hybrid_triplets(spark, sf):
    g = graphs.text_graph(spark, sf)
    return retrieve.hybrid_triplets(g, label_query(spark, sf), spanish_long_sources(spark, sf), 5)


# B12 streaming, C9-C11 property helpers -----------------------------------------

from quiver.functions import props  # noqa: E402
from quiver.streaming import incremental  # noqa: E402
from quiver.streaming import property_graph as graph_stream  # noqa: E402


@register("stream_upsert_edges", """
SELECT 'u:' || CAST(user_id AS VARCHAR) AS src, event_type AS label, 't:' || event_type AS dst,
       last(value ORDER BY ts, event_id) AS value
FROM events GROUP BY user_id, event_type""")
def q_stream_upsert_edges(spark, sf):
    state = incremental.run_event_stream(spark, sf, scratch_path(spark, "event-state"), glob="events.parquet")
    return state.select("src", "label", "dst", "value")


@register("stream_property_graph", S.with_(S.TEXT_CHUNKS, S.TEXT_ENTITIES, S.TEXT_EDGES, S.TEXT_MENTIONS) + """
SELECT 'entity' AS kind, node_table AS a_table, id AS a, label, CAST(NULL AS VARCHAR) AS b_table, CAST(NULL AS VARCHAR) AS b,
       CAST(NULL AS VARCHAR) AS source FROM text_entities
UNION ALL SELECT 'chunk', 'Chunk', id, label, NULL, NULL, NULL FROM text_chunks
UNION ALL SELECT 'edge', src_table, src, label, dst_table, dst, triplet_source_id FROM text_edges
UNION ALL SELECT 'mention', 'Chunk', chunk_id, 'MENTIONS', entity_table, entity_id, NULL FROM text_mentions
UNION ALL SELECT 'waiting', 'relations first', CAST((SELECT count(*) FROM documents) AS VARCHAR), NULL, NULL, '0', NULL
UNION ALL SELECT 'waiting', 'then entities', '0', NULL, NULL, CAST((SELECT count(*) FROM text_mentions) AS VARCHAR), NULL""")
def q_stream_property_graph(spark, sf):
    """Relations arrive first, then entities, then chunks: edges wait for their
    ends and mentions for their chunks; the stream is stopped in between."""
    base = graphs.text_graph_base(spark, sf)
    empty = PropertyGraph.create(spark, graphs.TEXT_SCHEMA, structured=True, embed_dim=graphs.EMBED_DIM)
    source, root = scratch_path(spark, "graph-changes"), scratch_path(spark, "graph-stream")
    g, left = empty, []
    for kind, stage, rows in (("relation", "relations first", graphs.text_relations(spark, sf)),
                              ("entity", "then entities", base.entities), ("chunk", None, base.chunks)):
        graph_stream.changes(kind, rows).write.mode("append").parquet(source)
        g = graph_stream.run_graph_stream(empty, source, root)
        if stage:
            edges, mentions = (w.agg(F.count(F.lit(1)).cast("string").alias("n")) for w in graph_stream.waiting(spark, root))
            left.append(edges.select(F.lit("waiting").alias("kind"), F.lit(stage).alias("a_table"), F.col("n").alias("a"),
                                     F.lit(mentions.first()["n"]).alias("b")))
    out = g.entities.select(F.lit("entity").alias("kind"), F.col("node_table").alias("a_table"), F.col("id").alias("a"), "label")
    for rows in (g.chunks.select(F.lit("chunk").alias("kind"), F.lit("Chunk").alias("a_table"), F.col("id").alias("a"), "label"),
                 g.edges.select(F.lit("edge").alias("kind"), F.col("src_table").alias("a_table"), F.col("src").alias("a"), "label",
                                F.col("dst_table").alias("b_table"), F.col("dst").alias("b"), F.col("triplet_source_id").alias("source")),
                 g.mentions.select(F.lit("mention").alias("kind"), F.lit("Chunk").alias("a_table"), F.col("chunk_id").alias("a"),
                                   F.lit("MENTIONS").alias("label"), F.col("entity_table").alias("b_table"), F.col("entity_id").alias("b")),
                 *left):
        out = out.unionByName(rows, allowMissingColumns=True)
    return out.select("kind", "a_table", "a", "label", "b_table", "b", "source")


PROP_KEYS = ["creation_date", "file_name", "file_path", "file_size", "file_type", "last_modified_date", "ref_doc_id"]


@register("compact_props", S.with_(S.TEXT_CHUNKS) + """
SELECT id, concat_ws(';',
  'file_name=' || nullif(file_name, ''), 'file_size=' || nullif(CAST(file_size AS VARCHAR), ''),
  'file_type=' || nullif(file_type, ''), 'ref_doc_id=' || nullif(ref_doc_id, '')) AS props
FROM text_chunks""")
def q_compact_props(spark, sf):
    c = graphs.text_chunks(spark, sf)
    m = props.compact(props.props_map(PROP_KEYS), drop=["file_path"])
    return c.select("id", props.render(m).alias("props"))


@register("sanitize_output", S.with_(S.TEXT_CHUNKS) + """
SELECT id, text, label, CAST(NULL AS DATE) AS creation_date, CAST(NULL AS DATE) AS last_modified_date, file_name,
       file_path, file_size, file_type, ref_doc_id FROM text_chunks""")
def q_sanitize_output(spark, sf):
    c = graphs.text_chunks(spark, sf).withColumn("_internal_rank", F.lit(1))
    return props.sanitize(c)


# G3, D14 triangle ----------------------------------------------------------------

@register("triple_rel_map_grouped", _triple_paths_oracle(2, 30).replace(
    "SELECT start AS subj, hops, path FROM paths",
    "SELECT start AS subj, string_agg(path, ';' ORDER BY path) AS paths FROM paths GROUP BY start"))
def q_triple_rel_map_grouped(spark, sf):
    g = traverse.triple_rel_map_grouped(graphs.chain_graph(spark, sf),
                                        segment_customer_ids(spark, sf, "BUILDING"), 2, 30)
    return g.select("subj", F.array_join("paths", ";").alias("paths"))


# a chunk, the source it mentions and the language it mentions, where the
# source publishes in that language (the edge between the two entity types first)
TRIANGLE = [
    ("s", "SOURCE", "PUBLISHES_IN", "l", "LANGUAGE"),
    ("c", "Chunk", "MENTIONS", "s", "SOURCE"),
    ("c", "Chunk", "MENTIONS", "l", "LANGUAGE"),
]


@register("match_triangle", S.with_(S.TEXT_EDGES, S.TEXT_MENTIONS) + """
SELECT e.src AS s, e.dst AS l, m1.chunk_id AS c
FROM text_edges e
JOIN text_mentions m1 ON m1.entity_table = 'SOURCE' AND m1.entity_id = e.src
JOIN text_mentions m2 ON m2.entity_table = 'LANGUAGE' AND m2.entity_id = e.dst AND m2.chunk_id = m1.chunk_id
WHERE e.label = 'PUBLISHES_IN'""")
def q_match_triangle(spark, sf):
    return traverse.match(graphs.text_graph(spark, sf), TRIANGLE)
