"""Scalar string/date helpers used by ingest and upsert."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that str.strip() removes.
_WS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def strip(c: Column) -> Column:
    """Trim leading and trailing whitespace (``trim`` only removes spaces)."""
    return F.regexp_replace(c, rf"^{_WS}+|{_WS}+$", "")


def to_date_or_null(c: Column) -> Column:
    """ISO date text -> DATE; text that does not parse becomes NULL, not an error."""
    return F.try_to_date(c.cast("string"), "yyyy-MM-dd")


def prefixed_id(prefix: str, c: Column) -> Column:
    """Node ids are prefixed strings so all node types share one key space."""
    return F.concat(F.lit(prefix), c.cast("string"))
