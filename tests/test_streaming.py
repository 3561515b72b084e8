"""Stream result equals batch result, across several micro-batches and a replay."""

from pyspark.sql import functions as F

from quiver.operators.merge import latest_by_key
from quiver.sources.tables import read_table
from quiver.streaming import incremental

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmpdir_path):
    ev = read_table(spark, SF, "events")
    src = tmpdir_path + "/events_in"
    # several files -> several micro-batches (one file per trigger); late rows
    # (older ts) arrive in later files for some keys
    ev.repartition(4, "event_id").write.mode("overwrite").parquet(src)
    state = incremental.run_event_stream(spark, src, tmpdir_path + "/state", tmpdir_path + "/ckpt",
                                         glob="*.parquet", max_files_per_trigger=1)
    got = sorted(state.select("src", "label", "dst", "value").collect())
    batch = latest_by_key(incremental.event_edges(ev), incremental.KEYS, "ts")
    want = sorted(batch.select("src", "label", "dst", "value").collect())
    assert got == want
    # a restart with the same checkpoint finds nothing new and keeps the state
    again = incremental.run_event_stream(spark, src, tmpdir_path + "/state", tmpdir_path + "/ckpt",
                                         glob="*.parquet", max_files_per_trigger=1)
    assert sorted(again.select("src", "label", "dst", "value").collect()) == want
    assert state.select(F.count("*")).first()[0] == len(want)


def test_compaction_keeps_state(spark, tmpdir_path):
    ev = read_table(spark, SF, "events")
    src = tmpdir_path + "/events_in"
    ev.repartition(3, "event_id").write.mode("overwrite").parquet(src)
    root = tmpdir_path + "/state"
    batch = latest_by_key(incremental.event_edges(ev), incremental.KEYS, "ts")
    want = sorted(batch.select("src", "label", "dst", "value").collect())
    incremental.run_event_stream(spark, src, root, glob="*.parquet", max_files_per_trigger=1)
    upto = incremental.compact(spark, root)
    assert upto == 2
    assert sorted(incremental.current_state(spark, root).select("src", "label", "dst", "value").collect()) == want
    # later events (newer ts, new values) arrive in the same source: the stream
    # continues with batch 3, after the compacted range
    late = ev.limit(50).withColumn("ts", F.lit("2100-01-01 00:00:00").cast("timestamp")).withColumn("value", F.lit(-1.0))
    late.write.mode("append").parquet(src)
    got = incremental.run_event_stream(spark, src, root, glob="*.parquet", max_files_per_trigger=1)
    want2 = sorted(latest_by_key(incremental.event_edges(ev.unionByName(late)), incremental.KEYS, "ts")
                   .select("src", "label", "dst", "value").collect())
    assert want2 != want
    assert sorted(got.select("src", "label", "dst", "value").collect()) == want2
