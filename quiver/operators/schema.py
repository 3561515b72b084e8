"""Schema introspection (node/edge properties, observed relationships, text
rendering) and schema conformance of candidate triples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiver.model import (CHUNK_SCHEMA, CHUNK_TABLE, EDGE_SCHEMA, ENTITY_SCHEMA, PropertyGraph)

# The type names reported for each column type.
TYPE_NAMES = {
    "string": "STRING",
    "date": "DATE",
    "bigint": "INT64",
    "int": "INT32",
    "double": "DOUBLE",
    "array<double>": "DOUBLE[]",
}

# Edge columns that are properties of the relation (the rest are endpoints).
EDGE_PROPS = ("label", "triplet_source_id")


def type_name(dt: T.DataType, embed_dim: int | None = None) -> str:
    s = dt.simpleString()
    if s == "array<double>" and embed_dim:
        return f"DOUBLE[{embed_dim}]"
    return TYPE_NAMES.get(s, s.upper())


def _props_literal(fields, embed_dim):
    return F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(f.name).alias("property"),
                              F.lit(type_name(f.dataType, embed_dim)).alias("type"))
                     for i, f in enumerate(fields)])


def node_tables(graph: PropertyGraph) -> DataFrame:
    """Declared entity tables plus Chunk, plus any table seen in the data."""
    declared = graph.spark.createDataFrame([(t,) for t in graph.entity_types()], "node_table string")
    return declared.unionByName(graph.entities.select("node_table")).distinct()


def node_props(graph: PropertyGraph) -> DataFrame:
    """(node_table, pos, property, type) for every node table."""
    ent = _props_literal([f for f in ENTITY_SCHEMA.fields if f.name != "node_table"], None)
    chk = _props_literal(CHUNK_SCHEMA.fields, graph.embed_dim)
    p = F.explode(F.when(F.col("node_table") == F.lit(CHUNK_TABLE), chk).otherwise(ent)).alias("p")
    return node_tables(graph).select("node_table", p).select("node_table", "p.*")


def rel_props(graph: PropertyGraph) -> DataFrame:
    """(label, pos, property, type) for every distinct edge label."""
    fields = [f for f in EDGE_SCHEMA.fields if f.name in EDGE_PROPS]
    labels = graph.edges.select("label").filter(F.col("label").isNotNull()).distinct()
    return labels.select("label", F.explode(_props_literal(fields, None)).alias("p")).select("label", "p.*")


def relationships(graph: PropertyGraph) -> DataFrame:
    """Observed (start, type, end) triples."""
    return (graph.edges.filter(F.col("label").isNotNull())
            .select(F.col("src_table").alias("start"), F.col("label").alias("type"),
                    F.col("dst_table").alias("end")).distinct())


def entity_types(rels: DataFrame) -> DataFrame:
    """Distinct sorted heads and tails of a (start, type, end) frame."""
    return (rels.select(F.explode(F.array("start", "end")).alias("entity_type"))
            .distinct().orderBy("entity_type"))


def _ordered_join(items: F.Column, sep: str) -> F.Column:
    """Join collected struct(k, s) values ordered by k."""
    return F.array_join(F.transform(F.array_sort(items), lambda x: x["s"]), sep)


def schema_text(graph: PropertyGraph) -> DataFrame:
    """One row, column ``schema``: the three-section text rendering."""
    np_ = node_props(graph).select("node_table", F.struct(
        F.col("pos").alias("k"), F.concat("property", F.lit(": "), "type").alias("s")).alias("x"))
    node_lines = np_.groupBy("node_table").agg(F.struct(
        F.col("node_table").alias("k"),
        F.concat("node_table", F.lit(" {"), _ordered_join(F.collect_list("x"), ", "), F.lit("}")).alias("s")
    ).alias("line"))
    rp = rel_props(graph).select("label", F.struct(
        F.col("pos").alias("k"), F.concat("property", F.lit(": "), "type").alias("s")).alias("x"))
    rel_lines = rp.groupBy("label").agg(F.struct(
        F.col("label").alias("k"),
        F.concat("label", F.lit(" {"), _ordered_join(F.collect_list("x"), ", "), F.lit("}")).alias("s")
    ).alias("line"))
    rs = relationships(graph).select(F.struct(
        F.concat_ws("\u0001", "start", "type", "end").alias("k"),
        F.concat(F.lit("(:"), "start", F.lit(")-[:"), "type", F.lit("]->(:"), "end", F.lit(")")).alias("s")
    ).alias("line"))
    # the three frames are schema-sized (tables, labels, label triples)
    parts = (node_lines.select(F.lit(0).alias("sec"), F.col("line.s").alias("s"), F.col("line.k").alias("k"))
             .unionByName(rel_lines.select(F.lit(1).alias("sec"), F.col("line.s").alias("s"), F.col("line.k").alias("k")))
             .unionByName(rs.select(F.lit(2).alias("sec"), F.col("line.s").alias("s"), F.col("line.k").alias("k"))))
    by_sec = parts.groupBy("sec").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("k", "s"))), lambda x: x["s"]), "\n").alias("body"))
    secs = F.array_sort(F.collect_list(F.struct("sec", "body")))

    def body(i):
        return F.coalesce(F.element_at(F.filter(secs, lambda x: x["sec"] == i), 1)["body"], F.lit(""))

    return by_sec.agg(F.concat_ws("\n", F.lit("Node properties:"), body(0), F.lit("Relationship properties:"),
                                  body(1), F.lit("The relationships:"), body(2)).alias("schema"))


def typed_triples(triples: DataFrame, types: DataFrame) -> DataFrame:
    """Give (src, predicate, dst) triples their endpoint types from
    ``types(id, node_table)``.  The types, one small row a node, are what a task
    holds; the triples stream past them and are never sorted or spilled."""
    t = types.select("id", "node_table").hint("shuffle_hash")
    return (triples.join(t.select(F.col("id").alias("src"), F.col("node_table").alias("head")), "src")
            .join(t.select(F.col("id").alias("dst"), F.col("node_table").alias("tail")), "dst")
            .select("src", "head", "predicate", "dst", "tail"))


def _schema_frame(graph_or_schema, spark) -> DataFrame:
    rows = list(graph_or_schema)
    # the schema is a driver-side list: its size is known, so broadcasting is safe
    return F.broadcast(spark.createDataFrame(rows, "head string, predicate string, tail string"))


def conforming(typed: DataFrame, rel_schema) -> DataFrame:
    """Triples whose (head, relation, tail) is in the schema; a relation label
    used with two (head, tail) pairs accepts both."""
    return typed.join(_schema_frame(rel_schema, typed.sparkSession), ["head", "predicate", "tail"], "left_semi")


def rejects(typed: DataFrame, rel_schema) -> DataFrame:
    return typed.join(_schema_frame(rel_schema, typed.sparkSession), ["head", "predicate", "tail"], "left_anti")
