import corpus_pipeline as c
import __spark_entry__ as entry
from quiver.llm import near_dedup, quality_rules
from quiver.llm.common import materialize
from helpers import by_id, empty

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    """Each stage against what brute force says about its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns, seen = docs.columns, {}
    for name, stage in c.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = materialize(stage(spark, docs, SF))
        seen[name] = (before, {r["doc_id"]: r for r in docs.collect()})
        if name != c.STAGES[-1][0]:
            assert docs.columns == columns
    before, after = seen["quality_rules"]
    verdict = by_id(quality_rules.op1_quality_rules(spark, SF), "kept")
    assert set(after) == {i for i in before if verdict[i][0]} and len(after) < len(before)
    before, after = seen["near_dedup"]
    text = spark.createDataFrame([(i, r["text"]) for i, r in before.items()], "doc_id long, text string")
    comp = by_id(near_dedup.duplicate_classes(text, 5, 80), "component_id")
    assert set(after) == {x[0] for x in comp.values()} and len(after) < len(before)
    before, after = seen["decontamination"]
    assert set(after) == {i for i, r in before.items() if not any(b in r["text"] for b in bench)} and len(after) < len(before)
    before, after = seen["pseudonyms"]
    assert set(after) == set(before) and any(after[i]["text"] != before[i]["text"] for i in after)
    assert all(r["n_chars"] == len(r["text"]) or r["text"] == before[i]["text"] for i, r in after.items())
    before, after = seen["piece_sampling"]
    assert set(after) == set(before) and all(r["lossless"] and r["n_bytes"] == len(before[i]["text"].encode()) for i, r in after.items())
    assert sorted(r["doc_id"] for r in c.run(spark, SF).select("doc_id").collect()) == sorted(after)


def test_empty_documents(spark):
    docs = empty(spark)
    for _, stage in c.STAGES:
        docs = materialize(stage(spark, docs, SF))
    assert docs.count() == 0


def test_registered():
    names = [k for k in entry.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14)) and "pipeline" in entry.queries()
