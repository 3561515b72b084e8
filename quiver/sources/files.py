"""Files in, edge lists out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiver.model import CHUNK_TABLE, PropertyGraph

NODE_COLS = ("node_table", "id", "name", "label")
EDGE_COLS = ("src_table", "src", "label", "dst_table", "dst")


def _meta():
    return [
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        # file systems keep no creation time that Spark can read: the file's own time stands for both
        F.to_date(F.col("_metadata.file_modification_time")).alias("creation_date"),
        F.to_date(F.col("_metadata.file_modification_time")).alias("last_modified_date"),
    ]


def read_text_files(spark: SparkSession, path: str, file_type: str = "text/plain") -> DataFrame:
    """One document per file (whole text) with its file metadata."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.col("value").alias("text"), *_meta(), F.lit(file_type).alias("file_type"))


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON-lines documents with the metadata of the file each came from."""
    df = spark.read.schema(schema).json(path)
    return df.select("*", *_meta(), F.lit("application/json").alias("file_type"))


def export_edge_list(edges: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write (src, label, dst) rows; csv keeps a header line."""
    w = edges.select("src", "label", "dst").write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def export_graph(graph: PropertyGraph, path: str, fmt: str = "csv") -> None:
    """Write ``nodes`` (node_table, id, name, label; chunks by their id) and
    ``edges`` (src_table, src, label, dst_table, dst) under ``path``, so that
    nodes without an edge are kept."""
    nodes = graph.entities.select(*NODE_COLS).unionByName(
        graph.chunks.select(F.lit(CHUNK_TABLE).alias("node_table"), "id", F.lit(None).cast("string").alias("name"), "label"))
    for name, rows in (("nodes", nodes), ("edges", graph.edges.select(*EDGE_COLS))):
        w = rows.write.mode("overwrite").format(fmt)
        (w.option("header", True).option("quoteAll", True).option("escape", '"') if fmt == "csv" else w).save(f"{path.rstrip('/')}/{name}")


def read_graph_export(spark: SparkSession, path: str, fmt: str = "csv") -> tuple[DataFrame, DataFrame]:
    """The nodes and edges that :func:`export_graph` wrote."""
    def read(name: str, cols: tuple[str, ...]) -> DataFrame:
        r = spark.read.schema(", ".join(f"{c} string" for c in cols)).format(fmt)
        return (r.option("header", True).option("escape", '"') if fmt == "csv" else r).load(f"{path.rstrip('/')}/{name}")
    return read("nodes", NODE_COLS), read("edges", EDGE_COLS)


def read_edge_list(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    schema = "src string, label string, dst string"
    if fmt == "csv":
        return spark.read.schema(schema).option("header", True).csv(path)
    if fmt == "json":
        return spark.read.schema(schema).json(path)
    return spark.read.schema(schema).parquet(path)
