"""Operator 12: alignment of two tokenizers' tokens, on Arrow arrays.

Both encodings of a text spell the same bytes, so tokens are aligned by where
they end.  A step takes some documents' id lists, flattens them, keeps each
id's parent, and sums token byte lengths per document (a running sum less its
value at the document's start).  The joined token bytes are compared with the
texts.  An Acero hash join on (document, end) keys then gives the links: A and
B tokens that end together.  They cut both token lists into groups.

How often a pair of ids is linked in the whole corpus needs one exchange, of
pairs and not of links.  A task cuts its documents into chunks of about
``CHUNK`` bytes of text; a chunk's distinct pairs and their counts
(``Table.group_by``) form a list, and its documents keep their links as places
in that list.  Spark adds the lists up (partial sums before the shuffle), finds
each B id's highest count and hands every chunk the totals of its own pairs;
the chunk and its list meet again in a cogroup, where totals are taken by place
and summed per document.  Nothing is broadcast but the two vocabulary files,
and what a task holds is a chunk (or one longer document) and its pairs.  Texts
are encoded once: the first pass is written to the shared folder.

Edge cases: null and empty texts, and texts that one of the tokenizers does not
spell exactly, have no tokens (zeros, empty digest); repeated rows count each
time; null ids are kept; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, read_docs, slices
from .vocab import BYTE_BPE, PIECE_BPE, ByteBpe, PieceBpe, cached, file_bytes

#: Bytes of text of one Arrow step (or one longer document).
STEP = 256 << 10
#: Bytes of text of the documents that share one list of pairs.
CHUNK = 8 << 20
FIRST = ("chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "links array<int>, pairs array<long>, counts array<long>")
DOC = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


class Vocabulary:
    """Arrow arrays of a vocabulary: the bytes of each id and their number."""

    def __init__(self, spelt: list[bytes]):
        self.bytes = pa.array(spelt, pa.large_binary())
        self.length = pa.array([len(x) for x in spelt], pa.int64())


class Names:
    """Decimal ids followed by each separator, as one array."""

    MARKS = (",", "|", ";")

    def __init__(self, size: int):
        self.size = size
        self.text = pa.array([f"{i}{m}" for m in self.MARKS for i in range(size)], pa.large_binary())


class Tools:
    def __init__(self, raw: tuple[bytes, bytes]):
        self.a, self.b = ByteBpe(raw[0], True), PieceBpe(raw[1])
        self.va, self.vb = Vocabulary(self.a.spelt), Vocabulary(self.b.spelt)
        self.names = Names(max(self.a.size, self.b.size))


def joined(taken: pa.Array, bounds: np.ndarray) -> pa.Array:
    """The bytes of consecutive values, joined between ``bounds``."""
    off = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset:taken.offset + len(taken) + 1]
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(off[bounds].copy()), taken.buffers()[2]])


def spelt_exactly(ids: pa.ListArray, vocabulary: Vocabulary, texts: pa.Array) -> np.ndarray:
    """Which rows' ids spell a space and the row's text."""
    bounds = np.asarray(ids.offsets, np.int64)
    bytes_ = joined(pc.take(vocabulary.bytes, pc.list_flatten(ids)), bounds - bounds[0])
    return pc.equal(bytes_, texts).to_numpy(zero_copy_only=False)


def token_ends(ids: pa.ListArray, vocabulary: Vocabulary) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Flat ids, the row each belongs to, and where its bytes end in the row
    (a running sum of lengths, begun again for each row)."""
    flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids)
    total = pc.cumulative_sum(pc.take(vocabulary.length, flat))
    ahead = pa.concat_arrays([pa.array([0], pa.int64()), total])
    return flat, parent, pc.subtract(total, pc.take(pc.take(ahead, ids.offsets), parent))


def align(a: pa.ListArray, b: pa.ListArray, tools: Tools) -> dict:
    """Links between two encodings of the same rows: the positions of linked
    tokens in the flat ids, in order."""
    a_id, a_row, a_end = token_ends(a, tools.va)
    b_id, b_row, b_end = token_ends(b, tools.vb)
    key = lambda row, end: pc.bit_wise_or(pc.shift_left(row.cast(pa.int64()), 40), end)
    left = pa.table({"at": key(a_row, a_end), "ia": pa.array(np.arange(len(a_id), dtype=np.int32))})
    right = pa.table({"at": key(b_row, b_end), "ib": pa.array(np.arange(len(b_id), dtype=np.int32))})
    both = left.join(right, "at", join_type="inner", use_threads=False)
    ia, ib = both["ia"].to_numpy(), both["ib"].to_numpy()
    order = np.argsort(ia, kind="stable")
    return {"a_id": a_id, "b_id": b_id, "a_row": a_row.to_numpy(), "ia": ia[order], "ib": ib[order]}


def group_texts(x: dict, n_a: np.ndarray, n_b: np.ndarray, names: Names) -> tuple[pa.Array, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` of all rows, token by token, and each row's first token."""
    la, lb = len(x["a_id"]), len(x["b_id"])
    last_a, last_b = np.zeros(la, bool), np.zeros(lb, bool)
    last_a[x["ia"]], last_b[x["ib"]] = True, True
    group_a = np.cumsum(last_a) - last_a
    group_b = np.cumsum(last_b) - last_b
    ends_a, ends_b = x["ia"].astype(np.int64) + 1, x["ib"].astype(np.int64) + 1
    before_b = np.concatenate([[0], ends_b])  # B tokens in earlier groups
    what = np.empty(la + lb, np.int64)
    what[np.arange(la) + before_b[group_a]] = x["a_id"].to_numpy() + names.size * last_a
    what[np.arange(lb) + ends_a[group_b]] = x["b_id"].to_numpy() + names.size * 2 * last_b
    return pc.take(names.text, pa.array(what)), np.concatenate([[0], np.cumsum(n_a + n_b)])


class Pairs:
    """A chunk's distinct pairs, in order of appearance, with counts."""

    def __init__(self):
        self.known, self.counts = pa.array([], pa.int64()), np.zeros(0, np.int64)

    def add(self, codes: pa.Array) -> pa.Array:
        """Counts the codes and returns their places in the list."""
        part = pa.table({"pair": codes}).group_by("pair", use_threads=False).aggregate([("pair", "count")])
        pair = part["pair"].combine_chunks()
        new = pc.filter(pair, pc.invert(pc.is_in(pair, value_set=self.known)))
        self.known = pa.concat_arrays([self.known, new])
        self.counts = np.concatenate([self.counts, np.zeros(len(new), np.int64)])
        self.counts[pc.index_in(pair, value_set=self.known).to_numpy()] += part["pair_count"].to_numpy()
        return pc.index_in(codes, value_set=self.known)


def lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def _step(col: pa.Array, s, tools: Tools, pairs: Pairs) -> list[pa.Array]:
    """Document columns of one slice; its pairs are added to the chunk's."""
    texts = col.slice(s.lo, s.n).fill_null("")
    full = np.diff(s.start) > 0
    as_py = texts.to_pylist()
    spaced = pc.binary_join_element_wise(*(pa.scalar(x, pa.large_string()) if isinstance(x, str) else x.cast(pa.large_string())
                                            for x in ("", texts, " "))).cast(pa.large_binary())
    a_ids = [tools.a.encode(" " + t) if t else np.zeros(0, np.uint32) for t in as_py]
    a = lists(pa.array(np.concatenate(a_ids).astype(np.int32)), np.array([len(i) for i in a_ids], np.int64))
    b = tools.b.encode(as_py)
    ok = full & spelt_exactly(a, tools.va, spaced) & spelt_exactly(b, tools.vb, spaced)
    if not ok.all():  # rows without tokens
        keep = pa.array(ok)
        a, b = (pc.if_else(keep, x, pa.array([[]], pa.list_(pa.int32()))[0]) for x in (a, b))
    n_a, n_b = pc.list_value_length(a).to_numpy().astype(np.int64), pc.list_value_length(b).to_numpy().astype(np.int64)
    x = align(a, b, tools)
    n_links = np.bincount(x["a_row"][x["ia"]], minlength=s.n).astype(np.int64)
    ids_a, ids_b = pc.take(x["a_id"], pa.array(x["ia"])), pc.take(x["b_id"], pa.array(x["ib"]))
    codes = pc.bit_wise_or(pc.shift_left(ids_b.cast(pa.int64()), 32), ids_a.cast(pa.int64()))
    text, first = group_texts(x, n_a, n_b, tools.names)
    whole = joined(text, first)
    at, data = np.frombuffer(whole.buffers()[1], np.int64), memoryview(whole.buffers()[2] or b"")
    digests = [hashlib.sha256(data[at[i]:at[i + 1] - 1]).hexdigest() if ok[i] else "" for i in range(s.n)]
    return [pa.array(n_a), pa.array(n_b), pa.array(n_links), pa.array(n_links), pa.array(digests, pa.string()), lists(pairs.add(codes), n_links)]


def _first_task(sent):
    kinds = {"chunk": pa.int64(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
             "groups_sha256": pa.string(), "links": pa.list_(pa.int32()), "pairs": pa.list_(pa.int64()), "counts": pa.list_(pa.int64())}

    def rows(n: int, have: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([have[k] if k in have else pa.nulls(n, t) for k, t in kinds.items()], names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = cached(Tools, sent.value)
        chunk, size, pairs = TaskContext.get().partitionId() << 32, 0, Pairs()
        own = lambda: rows(1, {"chunk": pa.array([chunk]), "pairs": lists(pairs.known, [len(pairs.known)]),
                               "counts": lists(pa.array(pairs.counts), [len(pairs.counts)])})
        for batch in batches:
            for s in slices(batch.column("text"), STEP):
                cols = _step(batch.column("text"), s, tools, pairs)
                names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]
                yield rows(s.n, {"chunk": pa.array(np.full(s.n, chunk)), "doc_id": batch.column("doc_id").slice(s.lo, s.n), **dict(zip(names, cols))})
                size += len(s.data)
                if size >= CHUNK:
                    yield own()
                    chunk, size, pairs = chunk + 1, 0, Pairs()
        if len(pairs.known):
            yield own()
    return run


def _sum_task(docs: pa.Table, totals: pa.Table) -> pa.Table:
    """n_best and count_sum of a chunk's documents; ``totals`` has a row for
    each pair of the chunk, by place."""
    order = pc.sort_indices(totals["place"])
    total = pc.take(totals["total"], order).combine_chunks().to_numpy()
    best = pc.take(totals["best"], order).combine_chunks().to_numpy()
    links = docs["links"].combine_chunks()
    n = pc.list_value_length(links).to_numpy().astype(np.int64)
    place = pc.list_flatten(links).to_numpy()
    end = np.cumsum(n)
    per_doc = lambda v: np.diff(np.concatenate([[0], np.cumsum(v, dtype=np.int64)])[np.concatenate([[0], end])])
    return pa.table({**{c: docs[c] for c in DOC}, "n_best": per_doc(total[place] == best[place]), "count_sum": per_doc(total[place])})


def aligned(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> tuple[DataFrame, DataFrame]:
    """Documents (with links as places in their chunk's list) and the chunks'
    lists of pairs: (chunk, place, b, a, n)."""
    sent = docs.sparkSession.sparkContext.broadcast((file_bytes(byte_bpe), file_bytes(piece_bpe)))
    first = materialize(docs.select("doc_id", "text").mapInArrow(_first_task(sent), FIRST))
    pairs = first.filter("pairs IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "p"))
    return (first.filter("pairs IS NULL").select("chunk", *DOC, "links"),
            pairs.select("chunk", "place", F.shiftright("p.pairs", 32).alias("b"), F.col("p.pairs").bitwiseAND(F.lit(0xFFFFFFFF)).alias("a"),
                         F.col("p.counts").alias("n")))


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(b, a, total, best): how often ids are linked, and the highest count of
    the B id with any A id."""
    total = pairs.groupBy("b", "a").agg(F.sum("n").alias("total"))
    return total.join(total.groupBy("b").agg(F.max("total").alias("best")), "b")


def align_tokenizers(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum."""
    rows, pairs = aligned(docs, byte_bpe, piece_bpe)
    totals = materialize(pair_counts(pairs))
    placed = pairs.join(totals, ["b", "a"]).select(F.col("chunk").alias("of"), "place", "total", "best")
    out = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in [*DOC, "n_best", "count_sum"])
    linked = rows.filter("n_links > 0").groupBy("chunk").cogroup(placed.groupBy("of")).applyInArrow(_sum_task, out)
    none = rows.filter("n_links = 0").select(*DOC, F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
    return linked.unionByName(none)


def op12_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    r = align_tokenizers(read_docs(spark, sf_dir, "doc_id", "text"))
    return r.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
