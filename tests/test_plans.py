"""Plan properties behind the scale design, checked on the physical plans."""


from quiver.operators import lookup, traverse, vector
from quiver.plans import catalog, graphs
from quiver.sources import snapshots

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _big(spark):
    """Tables too large to broadcast, results of a limit small enough."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")


def test_registered_walks_and_lookups_never_shuffle_names_or_texts(spark):
    """After the limit only few rows meet the name and text tables: no sort
    merge join has them on a side, whatever the tables' size."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        _big(spark)
        for name, column in (("rel_map_triplets", "_v"), ("keyword_retrieve", "_v"), ("triplets_limit", "_v"), ("triplets_with_text", "_v")):
            p = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
            for join in [x for x in p.splitlines() if "SortMergeJoin" in x]:
                assert "_t0" not in join, (name, join)
            assert any("_t0" in x for x in p.splitlines() if "BroadcastHashJoin" in x), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_job_before_an_action(spark):
    tracker = spark.sparkContext.statusTracker()
    g = graphs.star_graph(spark, SF)
    seeds, chain = catalog.segment_customer_ids(spark, SF, "BUILDING"), graphs.chain_graph(spark, SF)
    spark.sparkContext.setJobGroup("lazy", "lazy")
    try:
        traverse.rel_map(g, seeds, 3, 30), lookup.triplets(g, ids=seeds), traverse.triple_rel_map(chain, seeds)
        assert len(tracker.getJobIdsForGroup("lazy")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hot_keys_are_distinct_before_semi_joins(spark):
    p = _plan(lookup.get_nodes(graphs.text_graph(spark, SF), ids=catalog.german_node_ids(spark, SF)))
    assert "HashAggregate(keys=[_key" in p
    assert "HashAggregate" not in _plan(lookup.triple_exists(graphs.web_graph(spark, SF).with_(
        links=spark.createDataFrame([("a", "b", "c")], "src string, predicate string, dst string")),
        spark.createDataFrame([("a", "b", "c")], "src string, predicate string, dst string")))


def test_label_scan_on_snapshot_prunes_partitions(spark, tmpdir_path):
    root = tmpdir_path + "/g"
    snapshots.write_graph(graphs.star_graph(spark, SF), root)
    g = snapshots.read_graph(spark, root)
    p = _plan(lookup.label_scan(g, "SUPPLIER"))
    assert "PartitionFilters" in p and "SUPPLIER" in p


def test_batch_topk_uses_window_group_limit(spark):
    p = _plan(vector.topk_batch(graphs.text_chunks(spark, SF), catalog.label_centroids(spark, SF), 5, 64))
    assert "WindowGroupLimit" in p


def test_scans_read_only_used_columns(spark):
    p = _plan(graphs.star_graph(spark, SF).entities)
    assert "c_acctbal" not in p and "c_mktsegment" not in p
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in p


def test_limited_triplets_never_sort_merge_the_edges(spark):
    out = lookup.triplets(graphs.star_graph(spark, SF))
    assert "SortMergeJoin" not in _plan(out)
