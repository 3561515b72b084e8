"""Property maps: drop empty values, drop named keys, hide internal columns."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def props_map(cols: Sequence[str]) -> Column:
    """A string map of the named columns (values cast to string)."""
    return F.map_from_arrays(F.array(*[F.lit(c) for c in cols]),
                             F.array(*[F.col(c).cast("string") for c in cols]))


def compact(m: Column, drop: Sequence[str] = (), falsy: bool = False) -> Column:
    """Remove NULL and empty values (and with ``falsy`` also "0"/"false"),
    and the keys listed in ``drop``."""
    def keep(k, v):
        ok = v.isNotNull() & (v != F.lit(""))
        if falsy:
            ok = ok & ~v.isin("0", "0.0", "false", "[]")
        if drop:
            ok = ok & ~k.isin(list(drop))
        return ok
    return F.map_filter(m, keep)


def render(m: Column, sep: str = ";") -> Column:
    """Stable text form: key=value pairs sorted by key."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)),
                                    lambda e: F.concat(e["key"], F.lit("="), e["value"])), sep)


def sanitize(df: DataFrame, hidden: Sequence[str] = ("embedding",)) -> DataFrame:
    """Drop internal ``_``-prefixed columns and bulky vector columns."""
    return df.select(*[c for c in df.columns if not c.startswith("_") and c not in hidden])
