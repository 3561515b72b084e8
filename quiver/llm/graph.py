"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).collect()[0]
    return r["n"], r["h"]


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id each node of ``edges`` (a, b) reaches.

    Alternating large-star and small-star steps: every node links its larger
    neighbours, then its smaller ones, to its smallest neighbour, until the
    edges are stars around the smallest ids.  A hub's neighbours stay separate
    rows (a minimum and a join), so no group is gathered anywhere.
    """
    e = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(e)
    while before[0]:
        both = e.union(e.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = (both.filter("b > a").join(least, both["a"] == least["u"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        large = materialize(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low.withColumnRenamed("a", "u"), F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).filter("a <> b"))
        e = materialize(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        after = _state(e)
        if after == before:
            break
        before = after
    nodes = e.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    return nodes.union(e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
