"""One test per semantic decision of the graph operators."""

from pyspark.sql import functions as F

from quiver.model import PropertyGraph, TripleGraph
from quiver.functions.text import strip, to_date_or_null
from quiver.operators import lookup, merge, schema, traverse
from quiver.sources import snapshots

SCHEMA = [("PERSON", "TRAINED_AT", "ORG"), ("PERSON", "TRAINED_AT", "PLACE"),
          ("ORG", "BELONGS_TO", "ORG"), ("PLACE", "BELONGS_TO", "ORG")]


def _pg(spark, structured=True):
    g = PropertyGraph.create(spark, SCHEMA if structured else None, structured=structured)
    ents = spark.createDataFrame(
        [("ann", "PERSON"), ("acme", "ORG"), ("paris", "PLACE"), ("group", "ORG"), ("bob", None)],
        "name string, label string")
    return merge.upsert_entities(g, ents)[0]


def _rels(spark, rows):
    return spark.createDataFrame(rows, "label string, source_id string, target_id string, "
                                       "triplet_source_id string, seq int")


def test_q9_same_label_two_pairs(spark):
    g = _pg(spark)
    g, _ = merge.upsert_edges(g, _rels(spark, [("TRAINED_AT", "ann", "acme", None, 1),
                                            ("TRAINED_AT", "ann", "paris", None, 1),
                                            ("BELONGS_TO", "paris", "group", None, 1)]))
    got = {(r["src"], r["rel_table"], r["dst"]) for r in g.edges.collect()}
    assert got == {("ann", "PERSON_TRAINED_AT_ORG", "acme"), ("ann", "PERSON_TRAINED_AT_PLACE", "paris"),
                   ("paris", "PLACE_BELONGS_TO_ORG", "group")}
    # delete by label takes every (head, tail) pair the label has
    g2 = merge.delete(g, relation_names=["TRAINED_AT"])
    assert [r["label"] for r in g2.edges.collect()] == ["BELONGS_TO"]


def test_q10_q11_strict_mode_rejects(spark):
    g = _pg(spark)
    # bob has no label -> no table in strict mode -> rejected
    assert {r["id"] for r in g.entities.collect()} == {"ann", "acme", "paris", "group"}
    resolved, rejects = merge.resolve_relations(g, _rels(spark, [("LIKES", "ann", "acme", None, 1),
                                                                 ("TRAINED_AT", "ann", "nobody", None, 1)]))
    assert resolved.count() == 0 and rejects.count() == 2


def test_q11_generic_mode_routes_to_entity(spark):
    g = _pg(spark, structured=False)
    assert {r["node_table"] for r in g.entities.collect()} == {"Entity"}


def test_q13_q14_last_write_wins_and_null_overwrites(spark):
    g = PropertyGraph.create(spark)
    b1 = spark.createDataFrame([("x", "X", "f1", 1)], "name string, label string, file_name string, seq int")
    b2 = spark.createDataFrame([("x", "X", "f2", 2), ("x", "X", None, 3)],
                               "name string, label string, file_name string, seq int")
    g = merge.upsert_entities(merge.upsert_entities(g, b1)[0], b2)[0]
    rows = g.entities.collect()
    assert len(rows) == 1 and rows[0]["file_name"] is None


def test_upsert_twice_equals_once(spark):
    g = _pg(spark)
    rel = _rels(spark, [("TRAINED_AT", "ann", "acme", "c1", 1)])
    once = merge.upsert_edges(g, rel)[0]
    twice = merge.upsert_edges(once, rel)[0]
    assert sorted(once.edges.collect()) == sorted(twice.edges.collect())


def test_q2_q4_triplets_filters_and_null_label(spark):
    g = _pg(spark, structured=False)
    extra = spark.createDataFrame([("nolabel", None)], "name string, label string")
    g, _ = merge.upsert_entities(g, extra.withColumn("label", F.lit("Entity")))
    g = g.with_(entities=g.entities.withColumn(
        "label", F.when(F.col("id") == "nolabel", F.lit(None)).otherwise(F.col("label"))))
    g, _ = merge.upsert_edges(g, _rels(spark, [("KNOWS", "ann", "bob", None, 1), ("KNOWS", "nolabel", "ann", None, 1)]))
    t = lookup.triplets(g).collect()
    assert [(r["src"], r["dst"]) for r in t] == [("ann", "bob")]  # NULL-label source dropped
    # Q3: filters are ANDed
    assert lookup.triplets(g, entity_names=["ann"], relation_names=["NOPE"]).count() == 0
    assert lookup.triplets(g, entity_names=["ann"], ids=["ann"]).count() == 1


def test_q5_null_label_edges_do_not_expand(spark):
    g = _pg(spark, structured=False)
    g, _ = merge.upsert_edges(g, _rels(spark, [("KNOWS", "ann", "bob", None, 1)]))
    nolabel = g.edges.withColumn("label", F.lit(None).cast("string")).withColumn("src", F.lit("bob")) \
                     .withColumn("dst", F.lit("acme"))
    g = g.with_(edges=g.edges.unionByName(nolabel))
    rows = traverse.rel_map_paths(g, ["ann"], depth=3).collect()
    assert [r["path"] for r in rows] == ["ann|KNOWS|bob"]


def test_q8_ids_none_vs_empty(spark):
    g = _pg(spark)
    assert lookup.get_nodes(g, ids=None).count() == 4
    assert lookup.get_nodes(g, ids=[]).count() == 0
    assert lookup.get_nodes(g, properties={"label": "ORG"}).count() == 2
    assert lookup.get_nodes(g, properties={"file_name": None}).count() == 0  # NULL never matches


def test_delete_by_properties_keeps_null_rows(spark):
    g = _pg(spark)
    g2 = merge.delete(g, properties={"file_name": "x"})  # every file_name is NULL
    assert g2.entities.count() == 4


def test_cycle_walks_and_simple_paths(spark):
    tg = TripleGraph.from_links(spark.createDataFrame(
        [("a", "r", "b"), ("b", "r", "c"), ("c", "r", "a")], "src string, predicate string, dst string"))
    walks = {r["path"] for r in traverse.triple_rel_map(tg, ["a"], depth=3, limit=100).collect()}
    assert walks == {"a|r|b", "a|r|b|r|c", "a|r|b|r|c|r|a"}
    g = PropertyGraph.create(spark).with_(edges=tg.links.select(
        F.lit("Entity").alias("src_table"), "src", F.lit("LINKS").alias("rel_table"),
        F.col("predicate").alias("label"), F.lit("Entity").alias("dst_table"), "dst",
        F.lit(None).cast("string").alias("triplet_source_id")),
        entities=spark.createDataFrame([("Entity", x, x, "E") for x in "abc"],
                                       "node_table string, id string, name string, label string"))
    simple = {r["path"] for r in traverse.rel_map_paths(g, ["a"], depth=3, limit=100, simple=True).collect()}
    assert simple == {"a|r|b", "a|r|b|r|c"}


def test_depth_monotone(spark):
    tg = TripleGraph.from_links(spark.createDataFrame(
        [("a", "r", "b"), ("b", "r", "c"), ("b", "s", "d"), ("d", "r", "e")], "src string, predicate string, dst string"))
    d2 = {r["path"] for r in traverse.triple_rel_map(tg, ["a"], 2, 1000).collect()}
    d3 = {r["path"] for r in traverse.triple_rel_map(tg, ["a"], 3, 1000).collect()}
    assert d2 < d3


def test_q16_q17_q18_triple_store(spark):
    tg = TripleGraph.create(spark)
    tg = merge.triple_upsert(tg, spark.createDataFrame([("x", "self", "x"), ("a", "r", "b")],
                                                       "src string, predicate string, dst string"))
    assert sorted(r["id"] for r in tg.nodes.collect()) == ["a", "b", "x"]  # self-loop node once
    assert traverse.triple_rel_map(tg, [], 2).count() == 0  # empty subject list -> empty
    tg2 = merge.triple_delete(tg, spark.createDataFrame([("x", "nope", "a")], "src string, predicate string, dst string"))
    # the triple did not exist; x still has its self-loop, a still has an edge
    assert sorted(r["id"] for r in tg2.nodes.collect()) == ["a", "b", "x"]
    tg3 = merge.triple_delete(tg, spark.createDataFrame([("a", "r", "b")], "src string, predicate string, dst string"))
    assert sorted(r["id"] for r in tg3.nodes.collect()) == ["x"]


def test_strip_and_dates(spark):
    df = spark.createDataFrame([("\t  hi there \n",), ("2024-02-30",), ("2024-02-03",)], "s string")
    out = df.select(strip(F.col("s")).alias("t"), to_date_or_null(F.col("s")).alias("d")).collect()
    assert out[0]["t"] == "hi there"
    assert out[1]["d"] is None and str(out[2]["d"]) == "2024-02-03"


def test_schema_validation_and_conformance(spark):
    import pytest
    with pytest.raises(ValueError):
        PropertyGraph.create(spark, None, structured=True)
    with pytest.raises(ValueError):
        PropertyGraph.create(spark, [["A", "R", "B"]], structured=True)
    typed = spark.createDataFrame([("ann", "PERSON", "TRAINED_AT", "p", "PLACE"), ("ann", "PERSON", "LIKES", "p", "PLACE")],
                                  "src string, head string, predicate string, dst string, tail string")
    assert schema.conforming(typed, SCHEMA).count() == 1
    assert schema.rejects(typed, SCHEMA).count() == 1


def test_snapshot_roundtrip(spark, tmpdir_path):
    g = _pg(spark)
    root = tmpdir_path + "/g"
    assert snapshots.write_graph(g, root) == 1
    back = snapshots.read_graph(spark, root)
    assert sorted(back.entities.collect()) == sorted(g.entities.collect())
    assert back.rel_schema == tuple(SCHEMA) and back.structured
    # a second write is a new version; the first stays readable
    assert snapshots.write_graph(merge.clear(back), root) == 2
    assert snapshots.read_graph(spark, root).entities.count() == 0
    assert snapshots.read_graph(spark, root, 1).entities.count() == 4


def test_many_dead_seeds_change_nothing(spark):
    """Repeated, NULL and edgeless subjects give what the one live one gives."""
    tg = TripleGraph.from_links(spark.createDataFrame([("z1", "p", "y"), ("y", "q", "x")], "src string, predicate string, dst string"))
    few = spark.createDataFrame([("z1",)], "s string")
    many = (spark.range(40_000).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("s"))
            .unionByName(spark.createDataFrame([("z1",), ("z1",), (None,)], "s string")))
    want = [tuple(r) for r in traverse.triple_rel_map(tg, few, 2).collect()]
    assert [w[2] for w in want] == ["z1|p|y", "z1|p|y|q|x"]
    assert [tuple(r) for r in traverse.triple_rel_map(tg, many, 2).collect()] == want
    assert [tuple(r) for r in traverse.triple_rel_map(tg, ["z1", "z1", None], 2).collect()] == want


def test_limited_walks_equal_the_first_of_all_walks(spark):
    import random
    r = random.Random(5)
    rows = list({(f"n{r.randrange(12)}", r.choice("pq"), f"n{r.randrange(12)}") for _ in range(40)})
    tg = TripleGraph.from_links(spark.createDataFrame(rows, "src string, predicate string, dst string"))
    links = tg.links.select(F.lit("n").alias("src_table"), "src", F.col("predicate").alias("label"), F.lit("n").alias("dst_table"), "dst")
    seeds = tg.nodes.select(F.lit("n").alias("start_table"), F.col("id").alias("start"))
    all_ = [x["path_seq"] for x in traverse.expand(links, seeds, 3).orderBy("path_seq").collect()]
    for limit in (1, 7, 50):
        assert [x["path_seq"] for x in traverse.top_walks(links, seeds, 3, limit).collect()] == all_[:limit]


def test_parallel_edges_match_in_any_order(spark):
    g = PropertyGraph.create(spark)
    e = [("Entity", "a", "LINKS", l, "Entity", "b", t) for l, t in (("R", "1"), ("S", "1"), ("S", "2"))]
    g = g.with_(edges=spark.createDataFrame(e, g.edges.schema))
    one = [("x", "Entity", "R", "y", "Entity"), ("x", "Entity", "S", "y", "Entity")]
    assert traverse.match(g, one).count() == traverse.match(g, one[::-1]).count() == 2


def test_triple_snapshot_keeps_empty_predicates(spark, tmpdir_path):
    tg = TripleGraph.from_links(spark.createDataFrame([("a", "", "b"), ("a", None, "c")], "src string, predicate string, dst string"))
    snapshots.write_triples(tg, tmpdir_path + "/t")
    assert {tuple(r) for r in snapshots.read_triples(spark, tmpdir_path + "/t").links.collect()} == {("a", "", "b"), ("a", None, "c")}


def test_new_files_are_read(spark, tmpdir_path):
    from quiver.sources.tables import read_table
    t = spark.createDataFrame([(1, "x")], "r_regionkey int, r_name string")
    for n in (1, 2):
        t.write.mode("append").parquet(tmpdir_path + "/region.parquet")
        assert read_table(spark, tmpdir_path, "region").count() == n


def test_text_graph_sql_equals_upsert_operators(spark):
    from quiver.plans import graphs
    sf = "/root/testdata/sf0.001"
    a = graphs.text_graph(spark, sf)
    b = graphs.text_graph_by_upsert(spark, sf)
    assert sorted(a.edges.collect()) == sorted(b.edges.collect())
    assert sorted(a.mentions.collect()) == sorted(b.mentions.collect())
