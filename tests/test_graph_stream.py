"""A property graph streamed in any order equals the batch build."""

import random

from pyspark.sql import functions as F

from quiver.model import PropertyGraph
from quiver.operators import merge
from quiver.streaming import property_graph as pg

SCHEMA = [("PERSON", "WORKS_AT", "ORG"), ("PERSON", "LIVES_IN", "PLACE"), ("ORG", "WORKS_AT", "ORG")]
CHUNKS = "id string, text string, embedding array<double>, seq long"
ENTITIES = "name string, label string, file_name string, seq long"
RELATIONS = "label string, source_id string, target_id string, triplet_source_id string, seq long"


def _records(seed=5):
    rnd = random.Random(seed)
    chunks = [(f"d{i}", f"text {i} v{v}", [float(i), 1.0], v) for i in range(12) for v in range(rnd.randint(1, 2))]
    entities = [(f"p{i}", "PERSON", f"f{v}", v) for i in range(10) for v in range(rnd.randint(1, 3))]
    entities += [(f"o{i}", "ORG", None, 0) for i in range(4)] + [("l0", "PLACE", None, 0)]
    # one id in two tables: a relation from it stands for two candidate edges
    entities += [("p0", "ORG", None, 0)]
    relations = []
    for s in range(60):
        relations.append((rnd.choice(["WORKS_AT", "LIVES_IN", "UNKNOWN"]), f"p{rnd.randint(0, 12)}",
                          rnd.choice(["o0", "o1", "o3", "l0", "nowhere"]), rnd.choice([None, "d1", "d5", "d40"]), s))
    return chunks, entities, relations


def _sorted(df):
    return sorted(map(repr, df.collect()))


def _same(got, want):
    for table in ("entities", "chunks", "edges", "mentions"):
        assert _sorted(getattr(got, table)) == _sorted(getattr(want, table)), table


def _batch_build(spark, graph, chunks, entities, relations):
    g, _ = merge.upsert_chunks(graph, spark.createDataFrame(chunks, CHUNKS))
    g, _ = merge.upsert_entities(g, spark.createDataFrame(entities, ENTITIES))
    return merge.upsert_relations(g, spark.createDataFrame(relations, RELATIONS))[0]


def test_shuffled_stream_with_replays_and_snapshot_equals_batch(spark, tmpdir_path):
    graph = PropertyGraph.create(spark, SCHEMA, structured=True, embed_dim=2)
    chunks, entities, relations = _records()
    want = _batch_build(spark, graph, chunks, entities, relations)
    tagged = ([("chunk", r) for r in chunks] + [("entity", r) for r in entities] + [("relation", r) for r in relations])
    random.Random(1).shuffle(tagged)
    schemas = {"chunk": CHUNKS, "entity": ENTITIES, "relation": RELATIONS}
    parts = [tagged[i::3] for i in range(3)]
    root = tmpdir_path + "/graph"
    for n, part in enumerate(parts):
        frames = [pg.changes(k, spark.createDataFrame([r for kind, r in part if kind == k], schemas[k])) for k in pg.KINDS]
        batch = frames[0].unionByName(frames[1]).unionByName(frames[2])
        pg.apply_batch(graph, root, batch, n)
        pg.apply_batch(graph, root, batch, n)  # a replay changes nothing
        if n == 1:
            before = pg.current_graph(graph, root)
            seen = _sorted(before.edges)
            assert pg.compact(graph, root) == 1
            assert _sorted(pg.current_graph(graph, root).edges) == seen
    _same(pg.current_graph(graph, root), want)
    edges, mentions = pg.waiting(spark, root)
    assert edges.count() > 0  # ends that never come: nowhere, p10..p12
    assert {r["chunk_id"] for r in mentions.collect()} <= {"d40"}
    refused = pg.rejects(spark, root)
    assert {r["label"] for r in refused.collect()} == {"UNKNOWN"}


def test_edges_wait_for_their_ends_across_runs(spark, tmpdir_path):
    graph = PropertyGraph.create(spark)
    src, root = tmpdir_path + "/in", tmpdir_path + "/graph"
    rel = spark.createDataFrame([("LIKES", "a", "b", "d1", 1), ("LIKES", None, "b", "d1", 1)], RELATIONS)
    pg.changes("relation", rel).write.mode("append").parquet(src)
    g = pg.run_graph_stream(graph, src, root)
    assert g.edges.count() == 0 and pg.waiting(spark, root)[0].count() == 1 and pg.rejects(spark, root).count() == 1
    nodes = spark.createDataFrame([("a", None, None, 0), ("b", None, None, 0)], ENTITIES)
    pg.changes("entity", nodes).write.mode("append").parquet(src)
    g = pg.run_graph_stream(graph, src, root)
    assert [(r["src"], r["label"], r["dst"]) for r in g.edges.collect()] == [("a", "LIKES", "b")]
    assert g.mentions.count() == 0 and pg.waiting(spark, root)[1].count() == 2
    pg.changes("chunk", spark.createDataFrame([("d1", "t", None, 0)], CHUNKS)).write.mode("append").parquet(src)
    g = pg.run_graph_stream(graph, src, root)
    assert _sorted(g.mentions.select("entity_id")) == ["Row(entity_id='a')", "Row(entity_id='b')"]
    assert [d.count() for d in pg.waiting(spark, root)] == [0, 0]


def test_empty_stream_and_odd_rows(spark, tmpdir_path):
    graph = PropertyGraph.create(spark, embed_dim=3)
    assert pg.current_graph(graph, tmpdir_path + "/none").edges.count() == 0
    odd = pg.changes("chunk", spark.createDataFrame([(None, "x", None, None), ("c", "y", [1.0], 1)], CHUNKS))
    odd = odd.unionByName(odd.limit(1).withColumn("kind", F.lit("other")))
    root = tmpdir_path + "/odd"
    pg.apply_batch(graph, root, odd, 0)
    assert pg.current_graph(graph, root).chunks.count() == 0
    assert pg.rejects(spark, root).count() == 3
