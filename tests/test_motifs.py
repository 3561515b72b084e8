"""Variable-length and hub-safe motifs against brute force."""

import itertools
import random

import pytest

from quiver.model import EDGE_SCHEMA, PropertyGraph, conform
from quiver.operators import traverse
from quiver.operators.traverse import Hops

EDGE = "src_table string, src string, rel_table string, label string, dst_table string, dst string, triplet_source_id string"


def _graph(spark, edges):
    g = PropertyGraph.create(spark, [("N", "E", "N")], structured=True)
    rows = [(st, s, f"{st}_{lab}_{dt}", lab, dt, d, None) for st, s, lab, dt, d in edges]
    return g.with_(edges=conform(spark.createDataFrame(rows, EDGE), EDGE_SCHEMA))


def _walk_pairs(edges, labels, lo, hi, start, end):
    out = set()
    level = {((t, n), (t, n)) for t, n in {(e[0], e[1]) for e in edges} if t == start}
    for hop in range(1, hi + 1):
        level = {(o, (dt, d)) for o, at in level for st, s, lab, dt, d in edges if (st, s) == at and lab in labels}
        if hop >= lo:
            out |= {(o[1], n[1]) for o, n in level if n[0] == end}
    return out


def _random_edges(seed, n=60):
    rnd = random.Random(seed)
    table = lambda: rnd.choice(["N", "M"])
    return list({(table(), f"x{rnd.randint(0, 9)}", rnd.choice(["E", "F", "G"]), table(), f"x{rnd.randint(0, 9)}")
                 for _ in range(n)})


@pytest.mark.parametrize("lo,hi", [(1, 1), (1, 3), (2, 2), (2, 4)])
def test_reach_pairs_equal_all_walks_both_ways(spark, lo, hi):
    edges = _random_edges(lo * 10 + hi)
    g, hops = _graph(spark, edges), Hops(("E", "F"), lo, hi)
    want = _walk_pairs(edges, {"E", "F"}, lo, hi, "N", "M")
    got = traverse.reach_pairs(g, "N", hops, "M").collect()
    assert len(got) == len(want) and {(r.src, r.dst) for r in got} == want
    ids = spark.createDataFrame([("x1",), ("x2",), ("x2",), (None,)], "v string")
    got = traverse.reach_pairs(g, "N", hops, "M", ids).collect()
    assert {(r.src, r.dst) for r in got} == {p for p in want if p[0] in ("x1", "x2")}
    got = traverse.reach_pairs(g, "N", hops, "M", ids, backward=True).collect()
    assert {(r.src, r.dst) for r in got} == {p for p in want if p[1] in ("x1", "x2")}


def test_variable_length_edges_inside_a_motif(spark):
    edges = _random_edges(7, 160)
    g = _graph(spark, edges)
    pattern = [("a", "N", "G", "b", "M"), ("c", "N", Hops(("E",), 1, 2), "b", "M"), ("a", "N", Hops(("F",), 1, 3), "c", "N")]
    fixed = {(s, d) for st, s, lab, dt, d in edges if (st, lab, dt) == ("N", "G", "M")}
    up = _walk_pairs(edges, {"E"}, 1, 2, "N", "M")
    across = _walk_pairs(edges, {"F"}, 1, 3, "N", "N")
    want = sorted((a, b, c) for (a, b) in fixed for (c, b2) in up if b2 == b and (a, c) in across)
    assert want
    assert sorted(tuple(r) for r in traverse.match(g, pattern).collect()) == want
    assert sorted(tuple(r) for r in traverse.match(g, pattern, heavy=1).collect()) == want


def test_planted_hub_gives_the_same_triangles_without_pairing_its_neighbours(spark):
    rnd = random.Random(3)
    edges = [("N", f"s{i}", "E", "N", "hub") for i in range(300)]
    edges += [("N", f"s{rnd.randint(0, 299)}", "E", "N", f"s{rnd.randint(0, 299)}") for _ in range(400)]
    edges = list(dict.fromkeys(edges)) + edges[:2]  # parallel edges give separate bindings
    g = _graph(spark, edges)
    pattern = [("a", "N", "E", "b", "N"), ("a", "N", "E", "c", "N"), ("b", "N", "E", "c", "N")]
    pairs = [(e[1], e[4]) for e in edges]
    out = {}
    for s, d in pairs:
        out.setdefault(s, []).append(d)
    want = sorted((a, b, c) for a, b in pairs for c, c2 in itertools.product(out.get(a, []), out.get(b, [])) if c == c2)
    assert sorted(tuple(r) for r in traverse.match(g, pattern).collect()) == want
    assert sorted(tuple(r) for r in traverse.match(g, pattern, heavy=50).collect()) == want
    hot = traverse._hot([g.edges.selectExpr("src a", "dst c"), g.edges.selectExpr("src b", "dst c")], "c", 50)
    assert [r.c for r in hot.collect()] == ["hub"]


def test_two_edges_between_the_same_variables(spark):
    edges = [("N", "x", "E", "N", "y"), ("N", "x", "F", "N", "y"), ("N", "x", "E", "N", "z"), ("N", "w", "G", "N", "x"), ("N", "y", "F", "N", "y")]
    g = _graph(spark, edges)
    pattern = [("w", "N", "G", "a", "N"), ("a", "N", "E", "b", "N"), ("a", "N", "F", "b", "N"), ("b", "N", "F", "b", "N")]
    for heavy in (None, 1):
        assert [tuple(r) for r in traverse.match(g, pattern, heavy).collect()] == [("w", "x", "y")]


def test_bad_patterns(spark):
    g = _graph(spark, [("N", "x", "E", "N", "y")])
    with pytest.raises(ValueError):
        Hops(("E",), 0, 2)
    with pytest.raises(ValueError):
        Hops("E", 1, 2)
    with pytest.raises(ValueError):
        traverse.match(g, [("a", "N", "E", "b", "N"), ("c", "N", "E", "c", "N")])
    with pytest.raises(ValueError):
        traverse.match(g, [("a", "N", "E", "b", "N")], heavy=0)
    assert traverse.match(_graph(spark, [("N", "x", "F", "N", "y")]), [("a", "N", Hops(("E",), 1, 3), "b", "N")]).count() == 0
