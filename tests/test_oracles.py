"""Registered queries against their DuckDB oracles at sf0.001 (a
representative subset; scripts/check_oracles.py runs them all)."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from quiver.sources.tables import TABLES, table_path

SF = "/root/testdata/sf0.001"
SUBSET = ["triplets_by_entity", "rel_map_triplets", "triple_rel_map_depth3", "match_cycle", "upsert_edges",
          "delete_by_name", "schema_text", "vector_topk_batch", "ivf_topk_pruned", "chunk_documents", "hybrid_retrieve",
          "stream_upsert_edges", "cap_triples_per_chunk"]


def _digest(cols, rows):
    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 6))
        return repr(v)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return c


def test_every_query_has_an_oracle_or_is_listed():
    from quiver.plans.catalog import ORACLES, QUERIES
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["node_id", "origin", "pos", "score", "text"]
