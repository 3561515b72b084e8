"""Ingest jobs: files with metadata, chunking rule, embedding, edge-list export."""

import math
import os

from quiver.operators import ingest
from quiver.sources import files


def test_read_text_files_whole_with_metadata(spark, tmpdir_path):
    d = tmpdir_path + "/docs"
    os.makedirs(d)
    texts = {"a.txt": "First line.\nSecond line!", "b.txt": "  Only one sentence  "}
    for name, t in texts.items():
        with open(os.path.join(d, name), "w") as f:
            f.write(t)
    rows = {r["file_name"]: r for r in files.read_text_files(spark, d + "/*.txt").collect()}
    assert set(rows) == {"a.txt", "b.txt"}
    assert rows["a.txt"]["text"] == texts["a.txt"]  # whole file, newlines kept
    assert rows["b.txt"]["file_size"] == len(texts["b.txt"])
    assert rows["a.txt"]["file_type"] == "text/plain" and rows["a.txt"]["last_modified_date"] is not None


def test_chunking_rule(spark):
    long_sentence = " ".join(f"w{i}" for i in range(11)) + "."
    text = "One two three. Four five six seven! Eight nine? " + long_sentence + " Tail end."
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id long, text string")
    out = [(r["doc_id"], r["chunk_no"], r["n_words"], r["text"])
           for r in ingest.chunk_documents(df, size=5).orderBy("doc_id", "chunk_no").collect()]
    # greedy, whole sentences; the 11-word sentence is cut into 5-word pieces
    assert out == [
        (1, 0, 3, "One two three."),
        (1, 1, 4, "Four five six seven!"),
        (1, 2, 2, "Eight nine?"),
        (1, 3, 5, "w0 w1 w2 w3 w4"),
        (1, 4, 5, "w5 w6 w7 w8 w9"),
        (1, 5, 3, "w10. Tail end."),
    ]


def test_embedding_is_deterministic_and_unit(spark):
    df = spark.createDataFrame([("a", "the cat sat"), ("b", "the cat sat"), ("c", None)], "id string, text string")
    rows = {r["id"]: r["embedding"] for r in ingest.embed_chunks(df, dim=32).collect()}
    assert rows["a"] == rows["b"] and rows["c"] is None
    assert abs(math.sqrt(sum(x * x for x in rows["a"])) - 1.0) < 1e-12


def test_edge_list_formats(spark, tmpdir_path):
    edges = spark.createDataFrame([("a", "R", "b"), ("b", "S", "c")], "src string, label string, dst string")
    for fmt in ("csv", "json", "parquet"):
        p = f"{tmpdir_path}/edges_{fmt}"
        files.export_edge_list(edges, p, fmt)
        assert sorted(files.read_edge_list(spark, p, fmt).collect()) == sorted(edges.collect())


def test_link_extraction_and_cap(spark):
    html = '<a href="/x">x</a><a href="/y">y</a><a href="/x">x</a><a href="/z">z</a>'
    pages = spark.createDataFrame([(1, "http://p/1", html)], "page_id long, url string, html string")
    links = {r["dst"] for r in ingest.extract_links(pages, r'href="([^"]+)"').collect()}
    assert links == {"/x", "/y", "/z"}
    capped = [(r["pos"], r["dst"]) for r in
              ingest.cap_links_per_chunk(pages, r'href="([^"]+)"', 2).orderBy("pos").collect()]
    assert capped == [(1, "/x"), (2, "/y")]


def test_graph_export_keeps_lone_nodes_and_odd_names(spark, tmpdir_path):
    from quiver.model import PropertyGraph
    g = PropertyGraph.create(spark, (), structured=False).with_(
        entities=spark.createDataFrame([("T", "a", 'say "hi", you', "T"), ("T", "alone", None, "T"), ("T", "e", "", "T")], "node_table string, id string, name string, label string"),
        chunks=spark.createDataFrame([("c1", "text", "text_chunk")], "id string, text string, label string"),
        edges=spark.createDataFrame([("T", "a", "KNOWS", "T", "e")], "src_table string, src string, label string, dst_table string, dst string"))
    for fmt in ("csv", "json", "parquet"):
        files.export_graph(g, f"{tmpdir_path}/{fmt}", fmt)
        nodes, edges = files.read_graph_export(spark, f"{tmpdir_path}/{fmt}", fmt)
        assert {(r["node_table"], r["id"]) for r in nodes.collect()} == {("T", "a"), ("T", "alone"), ("T", "e"), ("Chunk", "c1")}
        assert {r["id"]: r["name"] for r in nodes.collect()}["a"] == 'say "hi", you'
        assert [tuple(r) for r in edges.collect()] == [("T", "a", "KNOWS", "T", "e")]
