"""A small property graph from end to end, and vector search on hand-made vectors."""

import math

from pyspark.sql import functions as F

from quiver.model import PropertyGraph
from quiver.operators import lookup, merge, retrieve, traverse, vector


def _harbour(spark):
    g = PropertyGraph.create(spark)  # generic mode: Entity / LINKS / Entity
    ents = spark.createDataFrame(
        [("Mirel", "PILOT", 1), ("Northgate", "HARBOUR", 1)], "name string, label string, seq int")
    chunk = spark.createDataFrame(
        [("log-7", "At dawn Mirel brought the barge into Northgate.", "text_chunk", 1)],
        "id string, text string, label string, seq int")
    g, _ = merge.upsert_entities(g, ents)
    g, _ = merge.upsert_chunks(g, chunk)
    rels = spark.createDataFrame(
        [("MOORS_AT", "Mirel", "Northgate", "log-7", 1),
         ("MENTIONS", "log-7", "Mirel", None, 1),   # source is a chunk, not an entity: no-op
         ("MENTIONS", "log-7", "Northgate", None, 1)],
        "label string, source_id string, target_id string, triplet_source_id string, seq int")
    return merge.upsert_relations(g, rels)[0]


def test_get_by_id(spark):
    rows = lookup.classify_nodes(lookup.get_nodes(_harbour(spark), ids=["Mirel"])).collect()
    assert [(r["label"], r["name"]) for r in rows] == [("PILOT", "Mirel")]


def test_rel_map_depth_one(spark):
    rows = traverse.rel_map(_harbour(spark), ["Mirel"], depth=1).collect()
    assert [(r["src"], r["src_name"], r["label"], r["dst"], r["dst_name"]) for r in rows] == [
        ("Mirel", "Mirel", "MOORS_AT", "Northgate", "Northgate")]


def test_label_scan_and_delete(spark):
    g = _harbour(spark)
    assert lookup.label_scan(g, "Entity").count() == 2
    g2 = merge.delete(g, ids=["Mirel", "Northgate"])
    assert lookup.label_scan(g2, "Entity").count() == 0
    assert g2.edges.count() == 0 and g2.mentions.count() == 0


def test_mentions_created_from_triplet_source(spark):
    g = _harbour(spark)
    assert {(r["chunk_id"], r["entity_id"]) for r in g.mentions.collect()} == {("log-7", "Mirel"), ("log-7", "Northgate")}
    ents = {r["entity_id"] for r in retrieve.entities_of_chunks(g, g.chunks.select("id")).collect()}
    assert ents == {"Mirel", "Northgate"}
    text = retrieve.with_source_text(g, lookup.triplets(g)).collect()
    assert [r["source_text"] for r in text] == ["At dawn Mirel brought the barge into Northgate."]


def _cos(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))


def test_vector_query_true_cosine(spark):
    dim = 48
    rows = [("tide", "low tide at noon", [1.0, -2.0, 0.5] * 16, "a.log", 1), ("wind", "wind from the west", [0.25, 1.5, 2.0] * 16, "b.log", 1)]
    batch = spark.createDataFrame(rows, "id string, text string, embedding array<double>, file_name string, seq int")
    g, bad = merge.upsert_chunks(PropertyGraph.create(spark, embed_dim=dim), batch)
    q = [0.5, 1.0, 1.25] * 16
    out = vector.topk(g.chunks, q, 2, dim).collect()
    expect = sorted(((_cos(r[2], q), r[0]) for r in rows), reverse=True)
    assert bad.count() == 0 and [r["id"] for r in out] == [e[1] for e in expect]
    assert all(abs(r["similarity"] - s) < 1e-12 for r, (s, _) in zip(out, expect))


def test_vector_query_skips_bad_vectors(spark):
    rows = [("ok", [1.0, 0.0], ), ("null", None), ("empty", []), ("short", [1.0]), ("zero", [0.0, 0.0])]
    chunks = spark.createDataFrame(rows, "id string, embedding array<double>").withColumn("text", F.lit("t"))
    assert [r["id"] for r in vector.topk(chunks, [1.0, 0.0], 10, 2).collect()] == ["ok"]


def test_rejects_come_back(spark):
    g = PropertyGraph.create(spark, embed_dim=2)
    batch = spark.createDataFrame([("a", "  hi ", [1.0, 0.0]), ("b", "x", [1.0]), (None, "y", None), ("c", "z", None)],
                                  "id string, text string, embedding array<double>")
    g, bad = merge.upsert_chunks(g, batch)
    assert {(r["id"], r["text"]) for r in g.chunks.collect()} == {("a", "hi"), ("c", "z")}
    assert sorted(r["text"] for r in bad.collect()) == ["x", "y"]
