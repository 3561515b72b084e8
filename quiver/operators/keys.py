"""Turning user-supplied id/name lists into joinable frames.

Keys, from a Python list or a DataFrame, become a frame of distinct non-NULL
values and are applied as one semi join without a hint: the planner knows a
list's size, AQE measures a frame's, and either is broadcast only if small.
Distinct keys (combined map-side) keep a key that occurs a million times from
becoming a million rows in one task: the right side of a semi join is never
split.
"""

from __future__ import annotations

from typing import Iterable, Union

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Keys = Union[None, Iterable[str], DataFrame]


def key_frame(spark: SparkSession, keys: Keys, col: str) -> DataFrame | None:
    if keys is None:
        return None
    if isinstance(keys, DataFrame):
        first = keys.columns[0]
        return keys.select(F.col(first).cast("string").alias(col)).filter(F.col(col).isNotNull()).distinct()
    vals = sorted({str(k) for k in keys if k is not None})
    return spark.createDataFrame([(v,) for v in vals], T.StructType([T.StructField(col, T.StringType(), False)]))


def restrict(df: DataFrame, col: str, keys: Keys) -> DataFrame:
    """Keep rows whose ``col`` is in ``keys``; None means no restriction,
    an empty list means no rows."""
    if keys is None:
        return df
    kf = key_frame(df.sparkSession, keys, "_key")
    return df.join(kf, F.col(col) == F.col("_key"), "left_semi")


NOWHERE = "\u0000"


def attach(rows: DataFrame, table: DataFrame, keys: list[str], value: str, requests: dict[str, list[str]]) -> DataFrame:
    """``rows`` (few) with columns looked up in ``table`` (large): for each
    new column, ``requests`` names the columns of ``rows`` that match ``keys``.

    All lookups are one inner join, so the few rows are the side the planner
    broadcasts and the table is scanned once and never shuffled; a row that
    finds nothing keeps NULLs, as in an outer join.  Each row is sent once
    with the key of a sentinel table row and once per lookup, and put together
    again by its number.
    """
    cols = rows.columns
    nowhere = [F.lit(NOWHERE).alias(f"_k{i}") for i in range(len(keys))]
    asks = [F.struct(F.lit("").alias("_for"), *nowhere)]
    for name, own in requests.items():
        asks.append(F.struct(F.lit(name).alias("_for"), *[F.col(c).cast("string").alias(f"_k{i}") for i, c in enumerate(own)]))
    sent = (rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("_ask", F.explode(F.array(*asks)))
            .select(*cols, "_row", "_ask.*"))
    sentinel = rows.sparkSession.createDataFrame([tuple([NOWHERE] * len(keys))], ", ".join(f"_t{i} string" for i in range(len(keys))))
    found = (table.select(*[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)], F.col(value).alias("_v"))
             .unionByName(sentinel.withColumn("_v", F.lit(None).cast(table.schema[value].dataType))))
    cond = [F.col(f"_k{i}") == F.col(f"_t{i}") for i in range(len(keys))]
    back = sent.join(found, cond).groupBy("_row", *cols).agg(
        *[F.max(F.when(F.col("_for") == name, F.col("_v"))).alias(name) for name in requests])
    return back.drop("_row")


def all_true(conds: list[Column]) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out
