"""Operator 4: exact removal of repeated 100-byte strings by sparse suffix
arrays, sorted deep-shallow.

A byte goes if a 100-byte string that also starts earlier (smaller doc_id, or
same document, earlier position) covers it.  The suffixes that get sorted are
those at anchors: of each window's ``K``-byte strings the one with the
smallest hash, leftmost.  Equal windows have equal anchors at equal offsets, so
comparing the texts around equal anchors decides about every window.  The plan
of :mod:`repeats` drops anchors that occur once, collapses runs equal in all
they cover to the first of them, and leaves the places where copies begin,
end or differ.  For those, each task sorts what follows the anchors (suffixes)
and what precedes them (reversed), both deep-shallow: a multikey quicksort on
``SHALLOW`` bytes, eight at a time, then a blind trie for every group still
equal.  Longest common prefixes of neighbours then tell, for every offset of
the window, which records agree on both sides; the first of them stays.

A group's records are dealt by anchor, half of the offsets, and the half window
that all of them cover, so an anchor inside a short common phrase is spread.

Edge cases: null and empty texts have no bytes (the digest is that of the
empty string); texts under 100 bytes are unchanged; a null doc_id comes after
all others; of repeated rows of one doc_id the one read first counts as
earlier; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_VALUE, SLICE_BYTES, Prefix, Slice, materialize, read_docs, small_batches
from .repeats import Runs, candidates, classify, covered, finish, shared_filter, texts_with

_U = np.uint64
WINDOW, K = 100, 32
SPAN = WINDOW - K + 1  # anchors a window can choose from
HALF = (WINDOW - K) // 2
SHALLOW = 16


def runs_of(s: Slice) -> Runs:
    """Runs of windows by anchor; ``off`` is the anchor's offset in the first."""
    data, n = s.data, len(s.data)
    size = np.diff(s.start)
    if n < WINDOW or size.max() < WINDOW:
        e = np.zeros(0, np.int64)
        return Runs(e.astype(np.uint64), e.astype(np.uint64), e, e, e, off=e)
    p = Prefix(BYTE_VALUE[data])
    at = np.arange(n - K + 1)
    h = p(at, at + K)
    end = s.start[1:][s.doc]
    bits = _U(max(20, int(n).bit_length()))
    best = ((h >> bits) << bits) | at.astype(np.uint64)
    best[end[:len(at)] < at + K] = np.iinfo(np.uint64).max
    step = 1
    while step * 2 <= SPAN:
        best = np.minimum(best[:-step], best[step:])
        step *= 2
    best = np.minimum(best[:n - WINDOW + 1], best[SPAN - step:SPAN - step + n - WINDOW + 1])
    ok = np.flatnonzero(end[:n - WINDOW + 1] >= np.arange(n - WINDOW + 1) + WINDOW)
    anchor = (best[ok] & ((_U(1) << bits) - _U(1))).astype(np.int64)
    first = np.ones(len(ok), bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (ok[1:] != ok[:-1] + 1)
    begin = np.flatnonzero(first)
    count = np.diff(np.append(begin, len(ok)))
    lo, a = ok[begin], anchor[begin]
    row = s.doc[lo].astype(np.int64)
    fp = p(lo, lo + count - 1 + WINDOW) + (a - lo).astype(np.uint64)
    return Runs(h[a], fp, lo - s.start[row], count, row, off=a - lo)


def clean(text: bytes) -> tuple[int, str]:
    return len(text), hashlib.sha256(text).hexdigest()


# ---- deep-shallow sorting -------------------------------------------------


def blind_trie(text: bytes, at: list[int], depth: int, limit: int) -> tuple[list[int], list[int]]:
    """Order of the strings ``text[i:i + limit]`` and the common prefix of each
    with the one before, given that all agree on ``depth`` bytes.  Inner nodes
    hold only the position of a difference and the byte of each branch; a
    string is placed by descending blindly, comparing once with the leaf
    reached, and branching at the true difference."""
    nodes: list = [("leaf", [at[0]])]  # or ("node", position, {byte: child})
    for i in at[1:]:
        path, cur = [], 0
        while nodes[cur][0] == "node":
            path.append(cur)
            kids = nodes[cur][2]
            cur = kids.get(text[i + nodes[cur][1]], next(iter(kids.values())))
        j = nodes[cur][1][0]
        d = depth
        if text[i + d:i + limit] == text[j + d:j + limit]:
            nodes[cur][1].append(i)
            continue
        step = 32
        while text[i + d:i + d + step] == text[j + d:j + d + step]:
            d += step
        while text[i + d] == text[j + d]:
            d += 1
        above = [x for x in path if nodes[x][1] < d]
        below = path[len(above)] if len(above) < len(path) else cur
        nodes.append(("leaf", [i]))
        leaf = len(nodes) - 1
        if nodes[below][0] == "node" and nodes[below][1] == d:
            nodes[below][2][text[i + d]] = leaf
            continue
        nodes.append(nodes[below])  # moved down; its place becomes the new branching
        nodes[below] = ("node", d, {text[j + d]: len(nodes) - 1, text[i + d]: leaf})
    order, lcp = [], []
    stack = [(0, depth)]  # node, common prefix with what was put out before
    while stack:
        cur, common = stack.pop()
        node = nodes[cur]
        if node[0] == "leaf":
            order += node[1]
            lcp += [common] + [limit] * (len(node[1]) - 1)
        else:
            kids = sorted(node[2])
            stack += [(node[2][b], common if k == 0 else node[1]) for k, b in reversed(list(enumerate(kids)))]
    return order, lcp


def sort_strings(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of equal-length strings (rows of bytes) within their groups, and
    each one's common prefix with the one before (0 at a group's start)."""
    n, limit = rows.shape
    words = np.ascontiguousarray(rows[:, :SHALLOW]).view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    part = np.cumsum(np.append(True, np.diff(group[order]) != 0)) - 1 if n else np.zeros(0, np.int64)
    lcp = np.zeros(n, np.int64)
    fresh = np.append(True, np.diff(part) != 0) if n else np.zeros(0, bool)
    for k in range(words.shape[1]):  # multikey quicksort, a word a level, only within what is still equal
        tied = np.zeros(n, bool)
        tied[1:] |= ~fresh[1:]
        tied[:-1] |= ~fresh[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        word = words[order[at], k]
        new = at[np.lexsort((word, part[at]))]
        order[at] = order[new]
        word = words[order[at], k]
        split = np.append(True, (word[1:] != word[:-1]) | (part[at][1:] != part[at][:-1]))
        within = split & ~fresh[at]
        j = at[within]
        x = words[order[j], k] ^ words[order[j - 1], k]
        lcp[j] = 8 * k + (x.astype(">u8").view(np.uint8).reshape(-1, 8) != 0).argmax(axis=1)
        fresh[at] |= split
        part = np.cumsum(fresh) - 1
    begin = np.flatnonzero(fresh)
    size = np.diff(np.append(begin, n))
    text = rows.tobytes()
    for b, m in zip(begin[size > 1].tolist(), size[size > 1].tolist(), strict=True):
        got, common = blind_trie(text, (order[b:b + m] * limit).tolist(), min(SHALLOW, limit), limit)
        order[b:b + m] = np.array(got) // limit
        lcp[b + 1:b + m] = common[1:]
    return order, lcp


# ---- the places where copies begin, end or differ ---------------------------

PIECES = "name long, half int, core long, ord long, uid long, lo int, off int, a int, b int, left binary, right binary"


def _piece_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per run to look at, up to two records: the windows with at least HALF
    bytes before the anchor, and the others.  ``a``..``b`` are the offsets of
    the anchor in them; ``left`` (reversed) and ``right`` the bytes around it."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        z, lists = batch.column("z").to_pylist(), batch.column("r")
        cut = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]) if len(z) else np.zeros(1, int)
        flat = lists.flatten()
        name, ord_, lo, n = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("name", "ord", "lo", "n"))
        uid = batch.column("uid").to_numpy(zero_copy_only=False)
        first = 0
        while first < len(z):
            texts, size = [], 0
            while first + len(texts) < len(z) and size < SLICE_BYTES:
                texts.append(unpack.decompress(z[first + len(texts)], max_output_size=1 << 31))
                size += len(texts[-1])
            last = first + len(texts)
            raw = b"".join(texts)
            s = Slice(first, last, np.frombuffer(raw, np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
            mine = slice(int(cut[first]), int(cut[last]))
            row = np.repeat(np.arange(last - first), np.diff(cut[first:last + 1]))
            at = s.start[row] + lo[mine]
            again = runs_of(s)
            off = again.off[np.searchsorted(s.start[again.row] + again.lo, at)]  # the anchor, by the same rule
            anchor, p = at + off, Prefix(BYTE_VALUE[s.data])
            for half in (0, 1):
                small = off - (n[mine] - 1)  # offsets of the anchor in the last and first window
                a, b = (np.maximum(small, HALF), off) if half else (small, np.minimum(off, HALF - 1))
                ok = np.flatnonzero(a <= b)
                x = anchor[ok]
                code = p(x - HALF, x + K) if half else p(x, x + WINDOW - HALF + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[mine][ok]), pa.array(np.full(len(ok), half, np.int32)), pa.array(code.view(np.int64)),
                     pa.array(ord_[mine][ok]), pa.array(uid[first:last][row[ok]]), pa.array(lo[mine][ok].astype(np.int32)),
                     pa.array(off[ok].astype(np.int32)), pa.array(a[ok].astype(np.int32)), pa.array(b[ok].astype(np.int32)),
                     pa.array([raw[i - k:i][::-1] for i, k in zip(x.tolist(), b[ok].tolist(), strict=True)], pa.binary()),
                     pa.array([raw[i:i + WINDOW - k] for i, k in zip(x.tolist(), a[ok].tolist(), strict=True)], pa.binary())],
                    names=[c.split()[0] for c in PIECES.split(", ")])
            first = last


def _grid(col: list[bytes], width: int) -> np.ndarray:
    """Byte strings as rows, filled up with zeros."""
    return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in col), np.uint8).reshape(-1, width)


def _classes(order: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """Number of each string's class: strings whose neighbours' common
    prefixes stay at or above ``least``."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(lcp < least)
    return out


def repeated_windows(left: list[bytes], right: list[bytes], a: np.ndarray, b: np.ndarray, group: np.ndarray,
                     rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(record, offset of the anchor) of every window that a record of smaller
    ``rank`` in the same group has too."""
    lw, rw = max(8, WINDOW - K), max(WINDOW, SHALLOW)
    L, R = sort_strings(_grid(left, max(SHALLOW, lw)), group), sort_strings(_grid(right, rw), group)
    who, where = [], []
    for off in range(int(a.min()), int(b.max()) + 1):
        have = np.flatnonzero((a <= off) & (b >= off))
        if len(have) < 2:
            continue
        x, y = _classes(*L, off)[have], _classes(*R, WINDOW - off)[have]
        by = np.lexsort((rank[have], y, x, group[have]))
        g = group[have][by]
        same = (x[by][1:] == x[by][:-1]) & (y[by][1:] == y[by][:-1]) & (g[1:] == g[:-1])
        hit = have[by[1:][same]]
        who.append(hit)
        where.append(np.full(len(hit), off))
    if not who:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(who), np.concatenate(where)


def _sort_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key: whole groups are handled together, several
    small ones at once."""
    held: list[pa.RecordBatch] = []

    def solve(batch: pa.Table) -> pa.RecordBatch:
        t = batch.to_pydict()
        key = np.array([t["name"], t["half"], t["core"]], np.int64)
        group = np.cumsum(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
        order = np.lexsort((np.array(t["lo"]), np.array(t["uid"]), np.array(t["ord"])))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        who, off = repeated_windows(t["left"], t["right"], np.array(t["a"]), np.array(t["b"]), group, rank)
        start = (np.array(t["lo"], np.int64) + np.array(t["off"]))[who] - off
        by = np.lexsort((start, who))
        who, start = who[by], start[by]
        first = np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (start[1:] != start[:-1] + 1))) if len(who) else np.zeros(0, int)
        number = np.diff(np.append(first, len(who)))
        return pa.RecordBatch.from_arrays([pa.array(np.array(t["uid"], np.int64)[who[first]]), pa.array(start[first].astype(np.int32)),
                                           pa.array(number.astype(np.int32))], names=["uid", "lo", "n"])

    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        if sum(x.num_rows for x in held) >= 20_000:
            t = pa.Table.from_batches(held).combine_chunks()
            key = np.array([t.column(c).to_numpy() for c in ("name", "half", "core")])
            new = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
            if len(new):  # all but the last group are complete
                cut = int(new[-1]) + 1
                yield solve(t.slice(0, cut))
                held = t.slice(cut).to_batches()
    if held:
        yield solve(pa.Table.from_batches(held).combine_chunks())


def _finish_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for b in batches:
        rows = []
        for z, r in zip(b.column("z").to_pylist(), b.column("r").to_pylist(), strict=True):
            text = unpack.decompress(z, max_output_size=1 << 31)
            gone = covered(len(text), [(x["lo"], x["n"]) for x in r or []], WINDOW)
            kept = np.frombuffer(text, np.uint8)[~gone]
            rows.append((len(text), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum()),
                         hashlib.sha256(kept.tobytes()).hexdigest()))
        cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def removed_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents with candidates, windows that go: uid, first, number)."""
    cand = candidates(docs, runs_of, clean, shared_filter(docs, runs_of))
    runs = classify(cand)
    whole = runs.filter("not rep").select("uid", "lo", "n")
    look = runs.filter("look").select("uid", "ord", "name", "lo", "n")
    pieces = texts_with(look, cand, "ord", "name", "lo", "n").select("uid", "z", "r").mapInArrow(_piece_task, PIECES)
    part = (pieces.repartition("name", "half", "core").sortWithinPartitions("name", "half", "core")
            .mapInArrow(_sort_task, "uid long, lo int, n int"))
    return cand, materialize(whole.unionByName(part))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    with small_batches(docs.sparkSession):
        cand, spans = removed_spans(docs)
    return finish(cand, spans, _finish_task, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
                  [F.col("size").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
                   F.col("sha").alias("kept_sha256")])


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(read_docs(spark, sf_dir, "doc_id", "text"))
