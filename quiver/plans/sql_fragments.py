"""DuckDB SQL that rebuilds the derived graphs from the raw tables.

These are the oracle side of the correctness check: each registered query has
an independent SQL formulation over the same parquet tables.
"""

from __future__ import annotations


def _id(prefix: str, col: str) -> str:
    return f"'{prefix}' || CAST({col} AS VARCHAR)"


STAR_ENTITIES = f"""star_entities AS (
  SELECT 'CUSTOMER' AS node_table, {_id('c:', 'c_custkey')} AS id, c_name AS name, 'CUSTOMER' AS label FROM customer
  UNION ALL SELECT 'ORDER', {_id('o:', 'o_orderkey')}, {_id('o:', 'o_orderkey')}, 'ORDER' FROM orders
  UNION ALL SELECT 'PART', {_id('p:', 'p_partkey')}, p_name, 'PART' FROM part
  UNION ALL SELECT 'SUPPLIER', {_id('s:', 's_suppkey')}, s_name, 'SUPPLIER' FROM supplier
  UNION ALL SELECT 'NATION', {_id('n:', 'n_nationkey')}, n_name, 'NATION' FROM nation
  UNION ALL SELECT 'REGION', {_id('r:', 'r_regionkey')}, r_name, 'REGION' FROM region
)"""

STAR_EDGES = f"""star_edges AS (
  SELECT 'CUSTOMER' AS src_table, {_id('c:', 'o_custkey')} AS src, 'CUSTOMER_PLACED_ORDER' AS rel_table,
         'PLACED' AS label, 'ORDER' AS dst_table, {_id('o:', 'o_orderkey')} AS dst,
         CAST(NULL AS VARCHAR) AS triplet_source_id FROM orders
  UNION ALL SELECT * FROM (SELECT DISTINCT 'ORDER', {_id('o:', 'l_orderkey')}, 'ORDER_CONTAINS_PART', 'CONTAINS',
         'PART', {_id('p:', 'l_partkey')}, CAST(NULL AS VARCHAR) FROM lineitem)
  UNION ALL SELECT * FROM (SELECT DISTINCT 'SUPPLIER', {_id('s:', 'l_suppkey')}, 'SUPPLIER_SUPPLIES_PART', 'SUPPLIES',
         'PART', {_id('p:', 'l_partkey')}, CAST(NULL AS VARCHAR) FROM lineitem)
  UNION ALL SELECT 'CUSTOMER', {_id('c:', 'c_custkey')}, 'CUSTOMER_LIVES_IN_NATION', 'LIVES_IN', 'NATION',
         {_id('n:', 'c_nationkey')}, CAST(NULL AS VARCHAR) FROM customer
  UNION ALL SELECT 'SUPPLIER', {_id('s:', 's_suppkey')}, 'SUPPLIER_BASED_IN_NATION', 'BASED_IN', 'NATION',
         {_id('n:', 's_nationkey')}, CAST(NULL AS VARCHAR) FROM supplier
  UNION ALL SELECT 'NATION', {_id('n:', 'n_nationkey')}, 'NATION_IN_REGION_REGION', 'IN_REGION', 'REGION',
         {_id('r:', 'n_regionkey')}, CAST(NULL AS VARCHAR) FROM nation
)"""

CHAIN_LINKS = f"""chain_links AS (
  SELECT {_id('c:', 'o_custkey')} AS src, 'PLACED' AS predicate, {_id('o:', 'o_orderkey')} AS dst FROM orders
  UNION ALL SELECT * FROM (SELECT DISTINCT {_id('o:', 'l_orderkey')}, 'CONTAINS', {_id('p:', 'l_partkey')} FROM lineitem)
  UNION ALL SELECT * FROM (SELECT DISTINCT {_id('p:', 'l_partkey')}, 'SUPPLIED_BY', {_id('s:', 'l_suppkey')} FROM lineitem)
  UNION ALL SELECT {_id('s:', 's_suppkey')}, 'BASED_IN', {_id('n:', 's_nationkey')} FROM supplier
  UNION ALL SELECT {_id('c:', 'c_custkey')}, 'LIVES_IN', {_id('n:', 'c_nationkey')} FROM customer
  UNION ALL SELECT {_id('n:', 'n_nationkey')}, 'IN_REGION', {_id('r:', 'n_regionkey')} FROM nation
),
chain_nodes AS (SELECT src AS id FROM chain_links UNION SELECT dst FROM chain_links)"""

WEB_LINKS = """web_links AS (
  SELECT DISTINCT url AS src, 'LINKS_TO' AS predicate, href AS dst
  FROM (SELECT url, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages)
),
web_nodes AS (SELECT src AS id FROM web_links UNION SELECT dst FROM web_links)"""

TEXT_CHUNKS = f"""text_chunks AS (
  SELECT {_id('d:', 'd.doc_id')} AS id, d.text AS text, 'text_chunk' AS label,
         CAST(e.embedding AS DOUBLE[]) AS embedding, d.source AS file_name,
         '/' || d.source || '/' || CAST(d.doc_id AS VARCHAR) || '.txt' AS file_path,
         d.n_chars AS file_size, 'text/plain' AS file_type, CAST(d.doc_id AS VARCHAR) AS ref_doc_id,
         d.lang AS lang
  FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id
)"""

TEXT_ENTITIES = f"""text_entities AS (
  SELECT 'SOURCE' AS node_table, 'src:' || source AS id, source AS name, 'SOURCE' AS label
  FROM (SELECT DISTINCT source FROM documents)
  UNION ALL
  SELECT 'LANGUAGE', 'lang:' || lang, lang, 'LANGUAGE' FROM (SELECT DISTINCT lang FROM documents)
)"""

# (source)-PUBLISHES_IN->(lang); triplet source = the latest document (by doc_id)
TEXT_EDGES = f"""text_edges AS (
  SELECT 'SOURCE' AS src_table, 'src:' || source AS src, 'SOURCE_PUBLISHES_IN_LANGUAGE' AS rel_table,
         'PUBLISHES_IN' AS label, 'LANGUAGE' AS dst_table, 'lang:' || lang AS dst,
         'd:' || CAST(max(doc_id) AS VARCHAR) AS triplet_source_id
  FROM documents GROUP BY source, lang
)"""

TEXT_MENTIONS = f"""text_mentions AS (
  SELECT DISTINCT {_id('d:', 'doc_id')} AS chunk_id, 'SOURCE' AS entity_table, 'src:' || source AS entity_id FROM documents
  UNION
  SELECT DISTINCT {_id('d:', 'doc_id')}, 'LANGUAGE', 'lang:' || lang FROM documents
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
