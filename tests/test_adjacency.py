"""Walks over a stored adjacency against walks over all edges."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quiver.model import EDGE_SCHEMA, TripleGraph
from quiver.operators import traverse
from quiver.plans import graphs
from quiver.sources import adjacency

SF = "/root/testdata/sf0.001"
COLS = ["start_table", "start", "hops", "path", "path_tables"]


def _edges(spark, rows):
    return spark.createDataFrame([(a, s, f"{a}_{l}_{b}", l, b, d, t) for a, s, l, b, d, t in rows], EDGE_SCHEMA).drop("rel_table")


def _rows(df):
    return [tuple(r) for r in df.select(*COLS).collect()]


def _seeds(spark, rows):
    return spark.createDataFrame(sorted({r[:2] for r in rows}), "start_table string, start string")


@pytest.mark.parametrize("depth,limit", [(1, 5), (3, 40)])
def test_random_graphs_equal_the_walks_over_all_edges(spark, tmpdir_path, depth, limit):
    r = random.Random(depth)
    table = lambda: r.choice(["N", "M"])
    rows = [(table(), f"x{r.randrange(9)}", r.choice(["E", "F"]), table(), f"x{r.randrange(9)}", r.choice(["t", None])) for _ in range(70)]
    rows += [("N", "x1", "HUB", "N", f"h{i}", None) for i in range(900)]  # a hub with most of the edges
    e = _edges(spark, rows)
    adj = adjacency.write_adjacency(e, f"{tmpdir_path}/a{depth}", keep=limit, buckets=4)
    assert _rows(traverse.stored_walks(adj, None, depth, limit)) == _rows(traverse.top_walks(e, _seeds(spark, rows), depth, limit))
    some = [x for x in rows if x[1] in ("x1", "x4")]
    want = _rows(traverse.top_walks(e, _seeds(spark, some), depth, limit))
    assert _rows(traverse.stored_walks(adj, ["x4", "x1", None, "no such"], depth, limit)) == want
    ids = spark.createDataFrame([("x1",), ("x1",), ("x4",), (None,)], "id string")
    assert _rows(traverse.stored_walks(adj, ids, depth, limit)) == want
    many = ["x1", "x4"] + [f"none{i}" for i in range(traverse.POINT_KEYS)]
    assert _rows(traverse.stored_walks(adj, many, depth, limit)) == want


def test_a_hub_is_bounded_when_written(spark, tmpdir_path):
    rows = [("N", "hub", "E", "N", f"d{i:05}", None) for i in range(3000)] + [("N", "d00001", "E", "N", "hub", None)]
    adj = adjacency.write_adjacency(_edges(spark, rows), f"{tmpdir_path}/a", keep=20, buckets=2)
    assert spark.table(adj.name).groupBy("src").count().collect() and spark.table(adj.name).filter("src = 'hub'").count() == 20
    with pytest.raises(ValueError):
        traverse.stored_walks(adj, None, 1, 21)


def _plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_hops_read_their_buckets_and_never_shuffle_edges(spark, tmpdir_path):
    g = graphs.star_graph(spark, SF)
    adj = adjacency.write_adjacency(adjacency.graph_edges(g), f"{tmpdir_path}/a", buckets=16)
    one = adj.edges(30).filter(F.col("node").isin(["CUSTOMER\u0001c:1"]))
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # else pruned buckets are not listed
    try:
        assert "SelectedBucketsCount: 1 out of 16" in _plan(one)
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = g.entities.filter("node_table = 'CUSTOMER'").select("id")
        plan = _plan(traverse._first_edges(adj, ids, 30))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # the seeds are dealt to the buckets, the edges stay where they are
    assert "Bucketed: true" in plan and "Exchange" in plan
    assert not re.search(r"Exchange\s+Input \[\d+\]: \[[^\]]*pos#", plan)


def test_opens_again_and_empty_graphs_have_no_walks(spark, tmpdir_path):
    rows = [("N", "a", "E", "N", "b", None), ("N", "b", "E", "N", "a", None)]
    root = f"{tmpdir_path}/a"
    first = adjacency.write_adjacency(_edges(spark, rows), root)
    spark.sql(f"DROP TABLE {first.name}")  # as in a session that never saw it
    again = adjacency.open_adjacency(spark, root)
    assert [r[3] for r in _rows(traverse.stored_walks(again, ["a"], 2, 5))] == ["a|E|b", "a|E|b|E|a"]
    assert _rows(traverse.stored_walks(again, [], 2, 5)) == []
    none = adjacency.write_adjacency(_edges(spark, rows).limit(0), f"{tmpdir_path}/b")
    assert _rows(traverse.stored_walks(none, None, 2, 5)) == []
    with pytest.raises(ValueError):
        traverse.rel_map_paths(None, simple=True, adjacency=again)


def test_triples_without_a_predicate(spark, tmpdir_path):
    links = spark.createDataFrame([("a", None, "b"), ("b", "p", "c"), (None, "p", "c")], "src string, predicate string, dst string")
    tg = TripleGraph(spark.createDataFrame([("a",), ("b",), ("c",)], "id string"), links)
    adj = adjacency.write_adjacency(adjacency.triple_edges(tg), f"{tmpdir_path}/a")
    got = sorted(map(tuple, traverse.triple_rel_map(tg, ["a", "b"], adjacency=adj).collect()))
    assert got == sorted(map(tuple, traverse.triple_rel_map(tg, ["a", "b"]).collect())) and len(got) == 3
