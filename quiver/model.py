"""Table schemas and the two immutable graph containers.

Property graph
  entities  one row per entity node, ``node_table`` says which node type
  chunks    text nodes with an embedding
  edges     typed, labelled edges between entities (``rel_table`` = schema triple)
  mentions  chunk -> entity links (the label-less MENTIONS relation)

Triple store
  nodes     ``id`` only
  links     ``src, predicate, dst`` with set semantics

Every mutating operator returns a new container; nothing is updated in place.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_TABLE = "Chunk"
GENERIC_ENTITY = "Entity"
GENERIC_RELATION = "LINKS"
CHUNK_LABEL = "text_chunk"
MENTIONS = "MENTIONS"

CHUNK_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("text", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.DoubleType())),
    T.StructField("creation_date", T.DateType()),
    T.StructField("last_modified_date", T.DateType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("file_type", T.StringType()),
    T.StructField("ref_doc_id", T.StringType()),
])

ENTITY_SCHEMA = T.StructType([
    T.StructField("node_table", T.StringType(), False),
    T.StructField("id", T.StringType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("creation_date", T.DateType()),
    T.StructField("last_modified_date", T.DateType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("file_type", T.StringType()),
    T.StructField("triplet_source_id", T.StringType()),
])

EDGE_SCHEMA = T.StructType([
    T.StructField("src_table", T.StringType(), False),
    T.StructField("src", T.StringType(), False),
    T.StructField("rel_table", T.StringType(), False),
    T.StructField("label", T.StringType()),
    T.StructField("dst_table", T.StringType(), False),
    T.StructField("dst", T.StringType(), False),
    T.StructField("triplet_source_id", T.StringType()),
])

MENTION_SCHEMA = T.StructType([
    T.StructField("chunk_id", T.StringType(), False),
    T.StructField("entity_table", T.StringType(), False),
    T.StructField("entity_id", T.StringType(), False),
])

NODE_SCHEMA = T.StructType([T.StructField("id", T.StringType(), False)])

LINK_SCHEMA = T.StructType([
    T.StructField("src", T.StringType(), False),
    T.StructField("predicate", T.StringType()),
    T.StructField("dst", T.StringType(), False),
])

REL_SCHEMA = T.StructType([
    T.StructField("head", T.StringType(), False),
    T.StructField("rel", T.StringType(), False),
    T.StructField("tail", T.StringType(), False),
])

Triple = tuple[str, str, str]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly the schema's columns, in order, cast to its types.

    Missing columns become typed NULLs, so callers may pass partial rows.
    """
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def rel_table_name(head: str, rel: str, tail: str) -> str:
    """One edge table per (head, relation, tail) schema triple."""
    return f"{head}_{rel}_{tail}"


def validate_relationship_schema(schema: Sequence) -> list[Triple]:
    """Schema items must be 3-tuples of strings."""
    out = []
    for item in schema:
        if not (isinstance(item, tuple) and len(item) == 3
                and all(isinstance(x, str) for x in item)):
            raise ValueError(
                "relationship schema must be a list of (head, relation, tail) "
                f"tuples, got {item!r}")
        out.append(item)
    return out


@dataclass(frozen=True)
class PropertyGraph:
    entities: DataFrame
    chunks: DataFrame
    edges: DataFrame
    mentions: DataFrame
    rel_schema: tuple[Triple, ...] = ((GENERIC_ENTITY, GENERIC_RELATION, GENERIC_ENTITY),)
    structured: bool = False
    embed_dim: int | None = None

    @staticmethod
    def create(spark: SparkSession, rel_schema: Sequence | None = None,
               structured: bool = False, embed_dim: int | None = None) -> "PropertyGraph":
        """A new, empty graph (tables exist but hold no rows)."""
        if structured:
            if rel_schema is None:
                raise ValueError("a relationship schema is required when structured=True")
            schema = tuple(validate_relationship_schema(rel_schema))
        else:
            schema = ((GENERIC_ENTITY, GENERIC_RELATION, GENERIC_ENTITY),)
        return PropertyGraph(empty(spark, ENTITY_SCHEMA), empty(spark, CHUNK_SCHEMA),
                             empty(spark, EDGE_SCHEMA), empty(spark, MENTION_SCHEMA),
                             schema, structured, embed_dim)

    @property
    def spark(self) -> SparkSession:
        return self.entities.sparkSession

    def entity_types(self) -> list[str]:
        """Sorted distinct heads and tails of the schema, plus Chunk."""
        return sorted({t[0] for t in self.rel_schema} | {t[2] for t in self.rel_schema}) + [CHUNK_TABLE]

    def with_(self, **kw) -> "PropertyGraph":
        return replace(self, **kw)

    def rel_schema_df(self) -> DataFrame:
        """The schema as a DataFrame; its size is that of the Python list."""
        rows = [(h, r, t) for h, r, t in self.rel_schema]
        return self.spark.createDataFrame(rows, REL_SCHEMA)

    def nodes(self) -> DataFrame:
        """All nodes, entity and chunk, in one frame keyed by (node_table, id)."""
        ents = self.entities.select(
            "node_table", "id", "name", "label", F.lit(None).cast("string").alias("text"),
            "creation_date", "last_modified_date", "file_name", "file_path",
            "file_size", "file_type", "triplet_source_id",
            F.lit(None).cast("string").alias("ref_doc_id"))
        chunks = self.chunks.select(
            F.lit(CHUNK_TABLE).alias("node_table"), "id",
            F.lit(None).cast("string").alias("name"), "label", "text",
            "creation_date", "last_modified_date", "file_name", "file_path",
            "file_size", "file_type", F.lit(None).cast("string").alias("triplet_source_id"),
            "ref_doc_id")
        return ents.unionByName(chunks)

    def register_views(self, prefix: str = "g_") -> None:
        """Expose the tables to ``spark.sql`` as temp views."""
        self.entities.createOrReplaceTempView(f"{prefix}entities")
        self.chunks.createOrReplaceTempView(f"{prefix}chunks")
        self.edges.createOrReplaceTempView(f"{prefix}edges")
        self.mentions.createOrReplaceTempView(f"{prefix}mentions")
        self.nodes().createOrReplaceTempView(f"{prefix}nodes")


@dataclass(frozen=True)
class TripleGraph:
    nodes: DataFrame
    links: DataFrame
    node_table: str = "entity"
    rel_table: str = "links"

    @staticmethod
    def create(spark: SparkSession, node_table: str = "entity",
               rel_table: str = "links") -> "TripleGraph":
        return TripleGraph(empty(spark, NODE_SCHEMA), empty(spark, LINK_SCHEMA),
                           node_table, rel_table)

    @staticmethod
    def from_links(links: DataFrame, **kw) -> "TripleGraph":
        """Links (set semantics) and the nodes they touch."""
        links = conform(links, LINK_SCHEMA).distinct()
        nodes = (links.select(F.col("src").alias("id"))
                 .unionByName(links.select(F.col("dst").alias("id"))).distinct())
        return TripleGraph(nodes, links, **kw)

    def with_(self, **kw) -> "TripleGraph":
        return replace(self, **kw)


__all__ = [
    "CHUNK_SCHEMA", "ENTITY_SCHEMA", "EDGE_SCHEMA", "MENTION_SCHEMA", "NODE_SCHEMA",
    "LINK_SCHEMA", "REL_SCHEMA", "PropertyGraph", "TripleGraph", "conform", "empty",
    "rel_table_name", "validate_relationship_schema",
]
