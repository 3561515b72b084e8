"""Graphs built from the input tables.

star   customers, orders, parts, suppliers, nations, regions as typed entities;
       PLACED, CONTAINS, SUPPLIES, LIVES_IN, BASED_IN, IN_REGION edges.
chain  the same facts as a triple store, oriented so walks run
       customer -> order -> part -> supplier -> nation -> region.
text   documents as chunks (embedding from ``embeddings`` where vec_id = doc_id),
       SOURCE and LANGUAGE entities, (source)-PUBLISHES_IN->(language) edges
       with the chunk as triplet source, and MENTIONS chunk -> entities.
web    (page url)-LINKS_TO->(href) triples extracted from ``pages.html``.
event  (user)-[event_type]->(type) edges whose value is the latest by ts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiver.functions.text import prefixed_id
from quiver.model import (CHUNK_SCHEMA, EDGE_SCHEMA, ENTITY_SCHEMA,
                          MENTION_SCHEMA, PropertyGraph, TripleGraph, conform)
from quiver.operators import merge
from quiver.sources.tables import read_table, sql_on_tables

# The relationship schema of the star graph.
STAR_SCHEMA = (
    ("CUSTOMER", "PLACED", "ORDER"),
    ("ORDER", "CONTAINS", "PART"),
    ("SUPPLIER", "SUPPLIES", "PART"),
    ("CUSTOMER", "LIVES_IN", "NATION"),
    ("SUPPLIER", "BASED_IN", "NATION"),
    ("NATION", "IN_REGION", "REGION"),
)

TEXT_SCHEMA = (("SOURCE", "PUBLISHES_IN", "LANGUAGE"),)

EMBED_DIM = 64


def _sid(prefix: str, col: str) -> str:
    return f"concat('{prefix}', CAST({col} AS STRING))"


# Each builder is one SQL statement: one analysis pass for the whole plan.
# DISTINCT runs on the integer keys, before the string ids are formed.
STAR_ENTITIES_SQL = f"""
SELECT 'CUSTOMER' AS node_table, {_sid('c:', 'c_custkey')} AS id, c_name AS name, 'CUSTOMER' AS label FROM {{customer}}
UNION ALL SELECT 'ORDER', {_sid('o:', 'o_orderkey')}, {_sid('o:', 'o_orderkey')}, 'ORDER' FROM {{orders}}
UNION ALL SELECT 'PART', {_sid('p:', 'p_partkey')}, p_name, 'PART' FROM {{part}}
UNION ALL SELECT 'SUPPLIER', {_sid('s:', 's_suppkey')}, s_name, 'SUPPLIER' FROM {{supplier}}
UNION ALL SELECT 'NATION', {_sid('n:', 'n_nationkey')}, n_name, 'NATION' FROM {{nation}}
UNION ALL SELECT 'REGION', {_sid('r:', 'r_regionkey')}, r_name, 'REGION' FROM {{region}}
"""

STAR_EDGES_SQL = f"""
SELECT 'CUSTOMER' AS src_table, {_sid('c:', 'o_custkey')} AS src, 'CUSTOMER_PLACED_ORDER' AS rel_table,
       'PLACED' AS label, 'ORDER' AS dst_table, {_sid('o:', 'o_orderkey')} AS dst FROM {{orders}}
UNION ALL SELECT 'ORDER', {_sid('o:', 'l_orderkey')}, 'ORDER_CONTAINS_PART', 'CONTAINS', 'PART', {_sid('p:', 'l_partkey')}
  FROM (SELECT DISTINCT l_orderkey, l_partkey FROM {{lineitem}})
UNION ALL SELECT 'SUPPLIER', {_sid('s:', 'l_suppkey')}, 'SUPPLIER_SUPPLIES_PART', 'SUPPLIES', 'PART', {_sid('p:', 'l_partkey')}
  FROM (SELECT DISTINCT l_suppkey, l_partkey FROM {{lineitem}})
UNION ALL SELECT 'CUSTOMER', {_sid('c:', 'c_custkey')}, 'CUSTOMER_LIVES_IN_NATION', 'LIVES_IN', 'NATION', {_sid('n:', 'c_nationkey')}
  FROM {{customer}}
UNION ALL SELECT 'SUPPLIER', {_sid('s:', 's_suppkey')}, 'SUPPLIER_BASED_IN_NATION', 'BASED_IN', 'NATION', {_sid('n:', 's_nationkey')}
  FROM {{supplier}}
UNION ALL SELECT 'NATION', {_sid('n:', 'n_nationkey')}, 'NATION_IN_REGION_REGION', 'IN_REGION', 'REGION', {_sid('r:', 'n_regionkey')}
  FROM {{nation}}
"""

CHAIN_LINKS_SQL = f"""
SELECT {_sid('c:', 'o_custkey')} AS src, 'PLACED' AS predicate, {_sid('o:', 'o_orderkey')} AS dst FROM {{orders}}
UNION ALL SELECT {_sid('o:', 'l_orderkey')}, 'CONTAINS', {_sid('p:', 'l_partkey')}
  FROM (SELECT DISTINCT l_orderkey, l_partkey FROM {{lineitem}})
UNION ALL SELECT {_sid('p:', 'l_partkey')}, 'SUPPLIED_BY', {_sid('s:', 'l_suppkey')}
  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM {{lineitem}})
UNION ALL SELECT {_sid('s:', 's_suppkey')}, 'BASED_IN', {_sid('n:', 's_nationkey')} FROM {{supplier}}
UNION ALL SELECT {_sid('c:', 'c_custkey')}, 'LIVES_IN', {_sid('n:', 'c_nationkey')} FROM {{customer}}
UNION ALL SELECT {_sid('n:', 'n_nationkey')}, 'IN_REGION', {_sid('r:', 'n_regionkey')} FROM {{nation}}
"""

STAR_TABLES = ("customer", "orders", "part", "supplier", "nation", "region", "lineitem")


def star_entities(spark: SparkSession, sf: str) -> DataFrame:
    return conform(sql_on_tables(spark, sf, STAR_ENTITIES_SQL, STAR_TABLES), ENTITY_SCHEMA)


def star_edges(spark: SparkSession, sf: str) -> DataFrame:
    return conform(sql_on_tables(spark, sf, STAR_EDGES_SQL, STAR_TABLES), EDGE_SCHEMA)


def star_graph(spark: SparkSession, sf: str) -> PropertyGraph:
    g = PropertyGraph.create(spark, STAR_SCHEMA, structured=True)
    return g.with_(entities=star_entities(spark, sf), edges=star_edges(spark, sf))


def chain_links(spark: SparkSession, sf: str) -> DataFrame:
    return sql_on_tables(spark, sf, CHAIN_LINKS_SQL, STAR_TABLES)


# The ends of CHAIN_LINKS_SQL, each id once: (prefix, key, table) of every end.
_CHAIN_ENDS = (("c:", "o_custkey", "orders"), ("c:", "c_custkey", "customer"), ("o:", "o_orderkey", "orders"),
               ("o:", "l_orderkey", "lineitem"), ("p:", "l_partkey", "lineitem"), ("s:", "l_suppkey", "lineitem"),
               ("s:", "s_suppkey", "supplier"), ("n:", "s_nationkey", "supplier"), ("n:", "c_nationkey", "customer"),
               ("n:", "n_nationkey", "nation"), ("r:", "n_regionkey", "nation"))


def _chain_nodes_sql() -> str:
    """DISTINCT per kind of node on the integer keys; a missing key gives a NULL
    end, and all of these are one node."""
    parts = []
    for prefix in dict.fromkeys(p for p, _, _ in _CHAIN_ENDS):
        keys = " UNION ALL ".join(f"SELECT {k} AS k FROM {{{t}}} WHERE {k} IS NOT NULL" for p, k, t in _CHAIN_ENDS if p == prefix)
        parts.append(f"SELECT {_sid(prefix, 'k')} AS id FROM (SELECT DISTINCT k FROM ({keys}))")
    none = " UNION ALL ".join(f"SELECT CAST(NULL AS STRING) AS id FROM {{{t}}} WHERE {k} IS NULL" for _, k, t in _CHAIN_ENDS)
    return " UNION ALL ".join([*parts, f"SELECT DISTINCT id FROM ({none})"])


def chain_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return sql_on_tables(spark, sf, _chain_nodes_sql(), STAR_TABLES)


def chain_graph(spark: SparkSession, sf: str) -> TripleGraph:
    return TripleGraph(chain_nodes(spark, sf), chain_links(spark, sf))


# Fixed value: the href pattern used for link extraction.
HREF_PATTERN = r'href="([^"]+)"'


def web_links(spark: SparkSession, sf: str) -> DataFrame:
    pages = read_table(spark, sf, "pages", "url", "html")
    return (pages.select("url", F.explode(F.regexp_extract_all("html", F.lit(HREF_PATTERN), 1)).alias("href"))
            .select(F.col("url").alias("src"), F.lit("LINKS_TO").alias("predicate"), F.col("href").alias("dst"))
            .distinct())


def web_graph(spark: SparkSession, sf: str) -> TripleGraph:
    return TripleGraph.from_links(web_links(spark, sf))


TEXT_CHUNKS_SQL = f"""
SELECT {_sid('d:', 'd.doc_id')} AS id, d.text, 'text_chunk' AS label, CAST(e.embedding AS ARRAY<DOUBLE>) AS embedding,
       d.source AS file_name, concat('/', d.source, '/', CAST(d.doc_id AS STRING), '.txt') AS file_path,
       d.n_chars AS file_size, 'text/plain' AS file_type, CAST(d.doc_id AS STRING) AS ref_doc_id
FROM {{documents}} d LEFT JOIN {{embeddings}} e ON d.doc_id = e.vec_id
"""

TEXT_ENTITIES_SQL = """
SELECT 'SOURCE' AS node_table, concat('src:', source) AS id, source AS name, 'SOURCE' AS label
FROM (SELECT DISTINCT source FROM {documents})
UNION ALL
SELECT 'LANGUAGE', concat('lang:', lang), lang, 'LANGUAGE' FROM (SELECT DISTINCT lang FROM {documents})
"""

# (source)-PUBLISHES_IN->(language) per document, merged: the triplet source
# is the latest document (highest doc_id) of each pair
TEXT_EDGES_SQL = """
SELECT 'SOURCE' AS src_table, concat('src:', source) AS src, 'SOURCE_PUBLISHES_IN_LANGUAGE' AS rel_table,
       'PUBLISHES_IN' AS label, 'LANGUAGE' AS dst_table, concat('lang:', lang) AS dst,
       concat('d:', CAST(max(doc_id) AS STRING)) AS triplet_source_id
FROM {documents} GROUP BY source, lang
"""

TEXT_MENTIONS_SQL = """
SELECT DISTINCT chunk_id, entity_table, entity_id FROM (
  SELECT concat('d:', CAST(doc_id AS STRING)) AS chunk_id, 'SOURCE' AS entity_table, concat('src:', source) AS entity_id
  FROM {documents}
  UNION ALL
  SELECT concat('d:', CAST(doc_id AS STRING)), 'LANGUAGE', concat('lang:', lang) FROM {documents})
"""

TEXT_TABLES = ("documents", "embeddings")


def text_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return conform(sql_on_tables(spark, sf, TEXT_CHUNKS_SQL, TEXT_TABLES), CHUNK_SCHEMA)


def text_entities(spark: SparkSession, sf: str) -> DataFrame:
    return conform(sql_on_tables(spark, sf, TEXT_ENTITIES_SQL, TEXT_TABLES), ENTITY_SCHEMA)


def text_relations(spark: SparkSession, sf: str) -> DataFrame:
    """One relation per document: its source publishes in its language."""
    docs = read_table(spark, sf, "documents", "doc_id", "source", "lang")
    return docs.select(F.lit("PUBLISHES_IN").alias("label"),
                       prefixed_id("src:", F.col("source")).alias("source_id"),
                       prefixed_id("lang:", F.col("lang")).alias("target_id"),
                       prefixed_id("d:", F.col("doc_id")).alias("triplet_source_id"),
                       F.col("doc_id").alias("seq"))


def text_graph_base(spark: SparkSession, sf: str) -> PropertyGraph:
    """Chunks and entities, no edges or mentions yet."""
    g = PropertyGraph.create(spark, TEXT_SCHEMA, structured=True, embed_dim=EMBED_DIM)
    return g.with_(entities=text_entities(spark, sf), chunks=text_chunks(spark, sf))


def text_graph(spark: SparkSession, sf: str) -> PropertyGraph:
    """Chunks, entities, edges and MENTIONS declared in SQL.  Equal to
    ``upsert_relations(text_graph_base, text_relations)`` (tested), which is
    how an incremental build would produce it."""
    g = text_graph_base(spark, sf)
    return g.with_(edges=conform(sql_on_tables(spark, sf, TEXT_EDGES_SQL, TEXT_TABLES), EDGE_SCHEMA),
                   mentions=conform(sql_on_tables(spark, sf, TEXT_MENTIONS_SQL, TEXT_TABLES), MENTION_SCHEMA))


def text_graph_by_upsert(spark: SparkSession, sf: str) -> PropertyGraph:
    """The text graph built with the merge operators (one relation per document)."""
    return merge.upsert_relations(text_graph_base(spark, sf), text_relations(spark, sf))[0]


__all__ = ["STAR_SCHEMA", "TEXT_SCHEMA", "EMBED_DIM", "star_graph", "star_entities", "star_edges",
           "chain_graph", "chain_links", "web_graph", "web_links", "text_graph", "text_chunks",
           "text_entities", "text_relations", "HREF_PATTERN", "MENTION_SCHEMA"]
