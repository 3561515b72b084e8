"""Vector arithmetic on ``array<double>`` columns with higher-order functions.

There is no built-in vector type in Spark SQL; ``zip_with`` + ``aggregate``
keep the work inside the JVM (no Python round trip per row).
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x))


def valid_vector(a: Column, dim: int | None) -> Column:
    """Not NULL, right length, and not the zero vector (cosine undefined)."""
    ok = a.isNotNull() & (F.size(a) > 0)
    if dim is not None:
        ok = ok & (F.size(a) == F.lit(dim))
    return ok & (norm(a) > F.lit(0.0))


def cosine_to_literal(a: Column, q: Sequence[float]) -> Column:
    """cos(a, q) for a fixed query vector; |q| is folded on the driver."""
    qn = math.sqrt(sum(float(x) * float(x) for x in q))
    if qn == 0.0:
        return F.lit(None).cast("double")
    return dot(a, literal_vector(q)) / (norm(a) * F.lit(qn))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))
