"""Operator 11: fill-in-the-middle with cut points from a Roaring-style set.

The ends of all units (tokens, or single characters) of a run of documents
form one sorted set of byte offsets.  It is kept in containers of 2^16 values:
a sorted array, a bitmap, or runs, whichever is smallest for what the container
holds (words give arrays and bitmaps, characters of plain ASCII give runs).
The containers' cumulative cardinalities say where the k-th member lies: a
binary search finds the container, a select inside it the offset.  Both cuts
of every document of the run are found in one call.

The cuts are drawn from ``sha256("<seed>:<key>")``, so a row is always cut the
same, wherever it is processed.  Documents are independent: one scan, no
shuffle; a step holds about ``STEP`` bytes of text or one longer document.

Edge cases: null texts count as empty; empty texts and texts that hold one of
the marks stay plain; a null key hashes as the empty string; repeated rows give
equal results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Slice, read_docs, slices

STEP = 1 << 20
SPAN = 16  # a container covers 2^16 consecutive values
MARKS = ("<P>", "<S>", "<M>")


class Container:
    """Members of one span of values, as 16-bit numbers in order."""

    def __init__(self, low: np.ndarray):
        self.card = len(low)
        first = np.flatnonzero(np.concatenate([[True], np.diff(low.astype(np.int64)) != 1]))
        if 2 + 4 * len(first) < min(2 * len(low), 8192):
            self.kind, self.first = "run", low[first].astype(np.int64)
            self.before = first.astype(np.int64)  # members ahead of each run
        elif len(low) <= 4096:
            self.kind, self.low = "array", low
        else:
            self.kind = "bitmap"
            bits = np.zeros(1 << SPAN, np.uint8)
            bits[low] = 1
            self.bytes = np.packbits(bits, bitorder="little").reshape(-1, 8)
            per_word = bits.reshape(-1, 64).sum(1, dtype=np.int64)
            self.before = np.cumsum(per_word) - per_word

    def select(self, k: np.ndarray) -> np.ndarray:
        """The k-th members (from 0)."""
        if self.kind == "array":
            return self.low[k].astype(np.int64)
        at = np.searchsorted(self.before, k, "right") - 1
        if self.kind == "run":
            return self.first[at] + (k - self.before[at])
        bits = np.unpackbits(self.bytes[at], axis=1, bitorder="little")
        nth = (np.cumsum(bits, axis=1, dtype=np.int16) <= (k - self.before[at])[:, None]).sum(1)
        return at * 64 + nth


class BoundarySet:
    """Sorted distinct non-negative integers with a fast k-th member."""

    def __init__(self, values: np.ndarray):
        values = np.asarray(values, np.int64)
        key = values >> SPAN
        cut = np.flatnonzero(np.diff(key)) + 1
        self.key = key[np.concatenate([[0], cut])] if len(key) else key
        self.containers = [Container(x) for x in np.split((values & 0xFFFF).astype(np.uint16), cut)] if len(key) else []
        #: members ahead of each container, and of the end
        self.before = np.concatenate([[0], np.cumsum([c.card for c in self.containers], dtype=np.int64)]).astype(np.int64)

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: np.ndarray) -> np.ndarray:
        """The members of rank ``k`` (from 0), in the order asked for."""
        k = np.asarray(k, np.int64)
        out = np.empty(len(k), np.int64)
        at = np.searchsorted(self.before, k, "right") - 1
        for c in np.unique(at):
            mine = at == c
            out[mine] = (int(self.key[c]) << SPAN) + self.containers[c].select(k[mine] - self.before[c])
        return out


def token_ends(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """End and row of each token: a word with the white space before it, or the
    white space that ends a text."""
    _, end, row = s.words()
    full = np.flatnonzero(np.diff(s.start) > 0)
    tail = full[SPACE[s.data[s.start[full + 1] - 1]]]
    ends, rows = np.concatenate([end, s.start[tail + 1]]), np.concatenate([row, tail])
    order = np.argsort(ends, kind="stable")
    return ends[order], rows[order]


def char_ends(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """End and row of each code point."""
    first = np.flatnonzero((s.data & 0xC0) != 0x80)
    return (np.append(first[1:], len(s.data)) if len(first) else first), s.doc[first]


UNITS = {"token": token_ends, "char": char_ends}


def draws(seed: int, key) -> list[int]:
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(h[8 * i:8 * i + 8], 16) for i in range(4)]


def _cut_task(unit: str, seed: int, rate: int, spm: int, marks: tuple[str, str, str]):
    p_mark, s_mark, m_mark = (m.encode() for m in marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices(b.column("text"), STEP):
                ends, rows = UNITS[unit](s)
                n = np.bincount(rows, minlength=s.n).astype(np.int64)
                h = np.array([draws(seed, k) for k in b.column("doc_id").slice(s.lo, s.n).to_pylist()], np.int64).reshape(-1, 4)
                k = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
                # the k-th end of a document; none before the first
                rank = (np.cumsum(n) - n)[:, None] + k - 1
                inside = k > 0
                cut = np.broadcast_to(s.start[:-1, None], k.shape).copy()
                cut[inside] = BoundarySet(ends).select(rank[inside])
                raw = s.data.tobytes()
                forms, outs = [], []
                for i in range(s.n):
                    lo, hi = int(s.start[i]), int(s.start[i + 1])
                    text = raw[lo:hi]
                    if lo == hi or h[i, 2] % 100 >= rate or p_mark in text or s_mark in text or m_mark in text:
                        forms.append("plain")
                        outs.append(text)
                        continue
                    a, z = (int(c) - lo for c in cut[i])
                    pre, mid, suf = text[:a], text[a:z], text[z:]
                    as_spm = h[i, 3] % 100 < spm
                    forms.append("spm" if as_spm else "psm")
                    outs.append(b"".join((s_mark, suf, p_mark, pre, m_mark, mid) if as_spm else (p_mark, pre, s_mark, suf, m_mark, mid)))
                starts_char = (s.data & 0xC0) != 0x80
                bounds = np.column_stack([s.start[:-1], cut]).ravel()
                chars = np.diff(np.concatenate([[0], np.cumsum(starts_char, dtype=np.int64)])[bounds])
                plain = np.array([f == "plain" for f in forms], bool)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(s.lo, s.n), pa.array(n), pa.array(forms, pa.string()), pa.array(chars[0::3], mask=plain),
                     pa.array(chars[1::3], mask=plain), pa.array(outs, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def fill_in_middle(docs: DataFrame, unit: str = "token", seed: int = 42, rate: int = 50, spm: int = 80,
                   marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and the output text.

    ``rate`` percent of the documents are cut, ``spm`` percent of these put the
    suffix first.  ``marks`` stand before prefix, suffix and middle; none may
    begin as it ends, or a text's last characters could be read as its start."""
    for m in marks:
        if not m or len(set(marks)) < 3 or any(m[:i] == m[-i:] for i in range(1, len(m))):
            raise ValueError(f"unusable marks {marks}")
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return src.mapInArrow(_cut_task(unit, seed, rate, spm, marks),
                          "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text an output was made from."""
    p, s, m = marks

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        """What follows the first, second and middle mark."""
        at2 = F.instr(output, second)
        at3 = F.instr(F.substring(output, at2, F.length(output)), m) + at2 - 1
        return (F.substring(output, F.lit(len(first) + 1), at2 - F.lit(len(first) + 1)),
                F.substring(output, at2 + len(second), at3 - at2 - len(second)),
                F.substring(output, at3 + len(m), F.length(output)))

    suf1, pre1, mid1 = parts(s, p)
    pre2, suf2, mid2 = parts(p, s)
    return F.when(form == "spm", F.concat(pre1, mid1, suf1)).when(form == "psm", F.concat(pre2, mid2, suf2)).otherwise(output)


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    r = fill_in_middle(read_docs(spark, sf_dir, "doc_id", "text"))
    return r.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                    F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS x, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
d AS (
  SELECT *, len(units) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS z,
         CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:z], '') AS mid, array_to_string(units[z + 1:], '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
                        ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
       sha256(x) AS restored_sha256
FROM p"""
