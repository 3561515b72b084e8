"""Read the input parquet tables.

Only the columns a caller names are read (``ReadSchema`` shows the pruned
schema), and filters applied afterwards are pushed into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The table as its files are now: nothing is remembered between calls."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


def table_state(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """Names the present files of tables: path, length and time of each."""
    out = []
    for name in names:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, name))
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = fs.listFiles(path, True)  # partition folders too
        while found.hasNext():
            st = found.next()
            out.append(f"{st.getPath()}:{st.getLen()}:{st.getModificationTime()}")
    return "|".join(sorted(out))


def sql_on_tables(spark: SparkSession, sf_dir: str, sql: str, tables: tuple[str, ...]) -> DataFrame:
    """Run ``sql`` with ``{table}`` placeholders bound to the input tables."""
    return spark.sql(sql, **{t: read_table(spark, sf_dir, t) for t in tables if f"{{{t}}}" in sql})
