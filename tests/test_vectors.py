"""Vector search: the blocked product against numpy, the cell index against
exact search, its refresh, and what a search reads."""

import random

import numpy as np
import pytest

from quiver.model import PropertyGraph
from quiver.operators import cells, retrieve, vector


def _rows(n=400, dim=16, seed=7, clusters=0):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(clusters)]
    return [(f"c{i:04d}", f"text {i}", [x + rnd.gauss(0, 0.05) for x in centres[i % clusters]] if clusters else [rnd.gauss(0, 1) for _ in range(dim)])
            for i in range(n)]


def _chunks(spark, **kw):
    return spark.createDataFrame(_rows(**kw), "id string, text string, embedding array<double>")


def _queries(spark, k=6, dim=16, seed=11):
    rnd = random.Random(seed)
    return spark.createDataFrame([(q, [rnd.gauss(0, 1) for _ in range(dim)]) for q in range(k)], "qid int, vec array<double>")


def _brute(rows, q, k):
    m = np.array([r[2] for r in rows])
    s = m @ np.array(q) / np.linalg.norm(m, axis=1) / np.linalg.norm(q)
    return [rows[i][0] for i in sorted(range(len(rows)), key=lambda i: (-round(s[i], 9), rows[i][0]))[:k]]


def _ids(df):
    return [r["id"] for r in sorted(df.collect(), key=lambda r: r["rank"])]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('index')}/i"
    rows = _rows(n=600, clusters=12)
    return rows, cells.build(spark.createDataFrame(rows, "id string, text string, embedding array<double>"), root, 16)


@pytest.mark.parametrize("on_driver", [4096, 0])
def test_search_is_exact_and_reads_few_cells(spark, built, monkeypatch, on_driver):
    monkeypatch.setattr(cells, "DRIVER_CELLS", on_driver)
    rows, idx = built
    q = rows[5][2]
    hits, n = cells.search_counted(spark, idx, q, 7)
    assert _ids(hits) == _brute(rows, q, 7)
    assert 0 < n["cells"] < n["all_cells"] and 7 <= n["rows"] < n["all_rows"] == 600
    assert _ids(cells.probe(spark, idx, q, 7, n["all_cells"])) == _brute(rows, q, 7)
    away = [-x for x in q]  # no cell is near: bounds still hold
    assert _ids(cells.search(spark, idx, away, 3)) == _brute(rows, away, 3)
    assert _ids(cells.search(spark, idx, q, 1000)) == _brute(rows, q, 1000)


def test_random_vectors_exact(spark, tmpdir_path):
    rows = _rows(n=300, dim=8)
    idx = cells.build(spark.createDataFrame(rows, "id string, text string, embedding array<double>"), tmpdir_path + "/i", 8, leaf=20)
    for seed in range(3):
        q = [random.Random(seed).gauss(0, 1) for _ in range(8)]
        assert _ids(cells.search(spark, idx, q, 5, first=1)) == _brute(rows, q, 5)


def test_layout_is_complete_and_well_placed(spark, built):
    rows, idx = built
    assert sorted(r["id"] for r in idx.rows(spark).select("id").collect()) == [r[0] for r in rows]
    assert cells.misplaced(idx, spark).count() == 0
    assert idx.cells(spark).count() == idx.n_cells > len(idx.coarse_centres(spark)) > 1
    p = idx.rows(spark).filter("coarse = 1 AND cell IN (1024, 1025)")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(coarse" in p and "PushedFilters: [In(cell" in p


def test_calibrated_recall(spark, built):
    rows, idx = built
    chunks = spark.createDataFrame(rows, "id string, text string, embedding array<double>")
    q = chunks.filter("substr(id, -1) = '0'").selectExpr("id AS qid", "embedding AS vec")
    r = vector.recall(cells.probe_batch(spark, idx, q, 5), vector.topk_batch(chunks, q, 5, 16)).first()
    assert r["n_exact"] == 300 and r["recall"] >= 0.9 and idx.nprobe < idx.n_cells


def test_refresh_writes_only_what_changed(spark, tmpdir_path):
    root, rows = tmpdir_path + "/i", _rows(n=400, clusters=8)
    schema = "id string, text string, embedding array<double>"
    chunks = spark.createDataFrame(rows, schema)
    a = cells.ensure(chunks, root, 16)
    assert cells.ensure(chunks, root, 16).version == a.version
    moved = [r if i != 3 else (r[0], r[1], rows[4][2]) for i, r in enumerate(rows) if i not in (10, 11)] + [("new", "", [0.5] * 16), ("null", "", None), ("zero", "", [0.0] * 16)]
    b = cells.ensure(spark.createDataFrame(moved, schema), root, 16)
    assert b.version > a.version and b.rewritten == 2 and b.n == 399 and b.changed == 5
    live = moved[:-2]
    for q in ([0.5] * 16, rows[4][2], rows[10][2]):
        assert _ids(cells.search(spark, b, q, 5)) == _brute(live, q, 5)
    assert sorted(r["id"] for r in b.rows(spark).collect()) == sorted(r[0] for r in live)
    # a row comes back as it was: the tombstone of its old place does not hide it
    back = [*live, rows[10]]
    c = cells.refresh(b, spark.createDataFrame(back, schema))
    assert c.rewritten == 1 and _ids(cells.search(spark, c, rows[10][2], 3)) == _brute(back, rows[10][2], 3)
    # the old version still answers as it did
    assert _ids(cells.search(spark, cells.open_index(spark, root, a.version), rows[10][2], 5)) == _brute(rows, rows[10][2], 5)
    # past the drift everything is built anew
    d = cells.refresh(c, spark.createDataFrame(rows[:150], schema))
    assert d.segments == (d.version,) and d.tombstones == () and d.n == 150 and cells.misplaced(d, spark).count() == 0


def test_identical_and_missing_vectors(spark, tmpdir_path):
    schema = "id string, text string, embedding array<double>"
    same = [(f"s{i:03d}", "", [1.0, 2.0, 3.0]) for i in range(200)] + [("other", "", [3.0, -2.0, 1.0])]
    idx = cells.build(spark.createDataFrame(same, schema), tmpdir_path + "/same", 3)
    assert _ids(cells.search(spark, idx, [2.0, 4.0, 6.0], 4)) == ["s000", "s001", "s002", "s003"]
    none = spark.createDataFrame([("a", "", None)], schema)
    assert cells.build(none, tmpdir_path + "/none", 3) is None
    g = PropertyGraph.create(spark, (), structured=False, embed_dim=3).with_(chunks=spark.createDataFrame(same, schema))
    assert _ids(retrieve.vector_query(g, [3.0, -2.0, 1.0], tmpdir_path + "/g", 1)) == ["other"]
    assert retrieve.vector_query(g.with_(chunks=none), [1.0, 0.0, 0.0], tmpdir_path + "/g2", 1).count() == 0


def test_blocked_product_equals_numpy(spark, monkeypatch):
    monkeypatch.setattr(vector, "BLOCK_ROWS", 32)  # many blocks on both sides
    rows = _rows(n=150) + [(f"d{i}", "", _rows(n=1)[0][2]) for i in range(9)] + [("short", "", [1.0])]
    chunks = spark.createDataFrame([*rows, ("none", "", None)], "id string, text string, embedding array<double>").repartition(5)
    qs = _queries(spark, k=70)
    got = vector.topk_batch(chunks, qs, 4, 16).collect()
    for qid, v in [tuple(r) for r in qs.collect()]:
        mine = [r["id"] for r in sorted((r for r in got if r["qid"] == qid), key=lambda r: r["rank"])]
        assert mine == _brute(rows[:-1], v, 4)
    assert vector.topk_batch(chunks, spark.createDataFrame([(1, [2.0])], "qid int, vec array<double>"), 4).first()["id"] == "short"
    dup = vector.topk_batch(chunks, spark.createDataFrame([("q", _rows(n=1)[0][2])], "qid string, vec array<double>"), 6, 16)
    assert _ids(dup) == ["c0000", "d0", "d1", "d2", "d3", "d4"]
    assert vector.topk_batch(chunks.limit(0), qs, 4).count() == 0


def test_many_queries(spark):
    chunks, qs = _chunks(spark, n=20), _queries(spark, k=5000)
    assert vector.topk_batch(chunks, qs, 2, 16).count() == 10000


def test_dimension_rule(spark):
    c = _chunks(spark, n=5)
    assert vector.choose_dimension(c, 7) == 16 and vector.choose_dimension(c.limit(0), 7) == 7
    assert vector.choose_dimension(c.limit(0)) is None


def test_state_sees_files_in_partition_folders(spark, tmpdir_path):
    from quiver.sources.tables import table_state
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    df.write.partitionBy("p").parquet(f"{tmpdir_path}/documents.parquet")
    one = table_state(spark, tmpdir_path, "documents")
    assert one == table_state(spark, tmpdir_path, "documents") and "p=a" in one
    df.filter("n = 2").write.mode("append").partitionBy("p").parquet(f"{tmpdir_path}/documents.parquet")
    assert table_state(spark, tmpdir_path, "documents") != one
