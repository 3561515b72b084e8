"""Fuzzy keyword matching against all pairs."""

import random

import pytest

from quiver.model import PropertyGraph
from quiver.operators import retrieve


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("distance", [1, 2])
def test_equals_all_pairs(spark, distance):
    r = random.Random(distance)
    text = lambda: "".join(r.choice("abcé") for _ in range(r.randrange(9)))
    names, words = [text() for _ in range(300)] + ["New York", None], [text() for _ in range(60)] + ["nwe york", None]
    g = PropertyGraph.create(spark, (), structured=False).with_(
        entities=spark.createDataFrame([("T", str(i), n) for i, n in enumerate(names)], "node_table string, id string, name string"))
    got = {(x["keyword"], x["id"], x["distance"]) for x in retrieve.keyword_matches(
        g, spark.createDataFrame([(w,) for w in words], "w string"), distance).collect()}
    want = {(w.lower(), str(i), e) for w in words if w is not None for i, n in enumerate(names) if n is not None
            if (e := edits(n.lower(), w.lower())) <= distance}
    assert got == want and len(want) > 200
    assert retrieve.keyword_matches(g, spark.createDataFrame([], "w string"), distance).count() == 0


def test_common_pieces_pair_nothing(spark):
    """Names and keywords that all share a piece are not joined on it."""
    names = spark.range(3000).selectExpr("'T' node_table", "cast(id as string) id", "format_string('warehouse#%09d', id * 7919 % 1000000) name")
    g = PropertyGraph.create(spark, (), structured=False).with_(entities=names)
    words = spark.range(3000).selectExpr("format_string('warehouse#%08d', id * 104729 % 1000000) w")
    got = {(x["keyword"], x["name"], x["distance"]) for x in retrieve.keyword_matches(g, words, 2).collect()}
    n = names.selectExpr("name")
    kw = words.selectExpr("w keyword").distinct()
    want = {(x["keyword"], x["name"], x["d"]) for x in n.crossJoin(kw).selectExpr("keyword", "name", "levenshtein(name, keyword, 2) d").filter("d >= 0").collect()}
    assert got == want and want
    close = retrieve._close_names(n.selectExpr("name", "length(name) size").distinct(), kw.selectExpr("keyword", "length(keyword) size"), 2)
    assert close.count() < 30 * len(want) < 3000 * 3000 / 5


def test_long_names(spark):
    """Names over VARIANT_MAX characters are met through their pieces."""
    r = random.Random(4)
    names = ["".join(r.choice("abcdef ") for _ in range(k)) for k in (46, 47, 48, 49, 50, 51, 52, 90)]
    g = PropertyGraph.create(spark, (), structured=False).with_(
        entities=spark.createDataFrame([("T", str(i), n) for i, n in enumerate(names)], "node_table string, id string, name string"))
    cut = [(n, i, k, (n[:k] + n[k + 1:])) for i, n in enumerate(names) for k in (0, 20, len(n) - 1)]
    words = {w for _, _, _, w in cut} | {w + "x" for _, _, _, w in cut} | {n + "xy" for n in names}
    got = {(x["keyword"], x["id"], x["distance"]) for x in retrieve.keyword_matches(g, spark.createDataFrame([(w,) for w in words], "w string"), 2).collect()}
    assert got == {(w, str(i), e) for w in words for i, n in enumerate(names) if (e := edits(n, w)) <= 2}


def test_nothing_goes_through_the_driver(spark, monkeypatch):
    """What keywords and names are made into is never broadcast, however small their tables look."""
    g = PropertyGraph.create(spark, (), structured=False).with_(
        entities=spark.range(40).selectExpr("'T' node_table", "cast(id as string) id", "format_string('warehouse#%09d', id) name"))
    words = spark.range(40).selectExpr("format_string('warehouse#%08d', id) w")
    written, write = [], retrieve.materialize
    monkeypatch.setattr(retrieve, "materialize", lambda df: (written.append(df), write(df))[1])
    got = retrieve.keyword_matches(g, words, 2)
    for df in (*written, got):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert len(written) == 1 and got.count() > 40
