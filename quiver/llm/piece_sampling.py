"""Operator 2: SentencePiece encoding by forward-filtering backward-sampling,
and lossless decoding.

A text (with the model's leading space, spaces as U+2581) is cut into chunks
that no piece crosses: line breaks, and words with the spaces before them
(runs longer than ``WORD`` characters or 16 spaces are cut there).  The piece
lattice of a chunk is the same wherever it occurs, so each distinct chunk of a
slice is filtered once: forward sums of segmentation weights for all chunks of
one length together, giving for every position the distribution of the last
piece.  Every occurrence then samples its pieces backwards, all occurrences at
once, with numbers hashed from (seed, row key, chunk number, step): the same
row always gets the same segmentation, however the data are partitioned.

A piece of score s weighs ``(2 - s) ** -alpha`` (scores of a BPE model are
negative ranks); a character without a piece is spelt in byte pieces, as is a
literal U+2581, so decoding gives back the very text.  Only tables derived
from the model file (a few MB, by its vocabulary size) are broadcast.

Edge cases: null and empty texts have no pieces and decode to the empty text;
repeated rows give equal results; a null key counts as key -1; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, read_docs, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁"
LONGEST, WORD = 16, 64
CHUNK = re.compile(r"\n| {0,16}[^ \n]{1,%d}| {1,16}" % WORD)
SLICE = 2 << 20
CELLS = 1 << 20
_U = np.uint64


def load_tables(path: str = MODEL, alpha: float = 0.7) -> dict[str, np.ndarray]:
    """Trie of the pieces in an open-addressing table, weights, and the bytes
    each id decodes to."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    size = sp.get_piece_size()
    byte_id = np.full(256, -1, np.int32)
    classes: dict[str, int] = {}
    child: dict[tuple[int, int], int] = {}
    term, weight = [-1], [0.0]
    spelt = [b""] * size
    for i in range(size):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_id[int(piece[3:5], 16)] = i
            spelt[i] = bytes([int(piece[3:5], 16)])
            continue
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or len(piece) > LONGEST:
            continue
        if SPACE_MARK in piece.lstrip(SPACE_MARK) or "\n" in piece:
            raise ValueError(f"piece {piece!r} crosses a chunk border")
        node = 0
        for ch in piece.replace(SPACE_MARK, " "):
            c = classes.setdefault(ch, len(classes) + 1)
            nxt = child.get((node, c))
            if nxt is None:
                nxt = child[node, c] = len(term)
                term.append(-1)
                weight.append(0.0)
            node = nxt
        term[node] = i
        weight[node] = (2.0 - sp.get_score(i)) ** -alpha
        spelt[i] = piece.replace(SPACE_MARK, " ").encode()
    if (byte_id < 0).any():
        raise ValueError("the model has no byte pieces")
    width = len(classes) + 1
    class_of = np.zeros(0x110000, np.int16)
    class_of[[ord(c) for c in classes]] = list(classes.values())
    bits = int(np.ceil(np.log2(len(child) * 4)))
    keys, to = np.full((1 << bits) + 64, -1, np.int64), np.zeros((1 << bits) + 64, np.int32)
    for (node, c), nxt in child.items():
        k = node * width + c
        slot = ((k * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) >> (64 - bits)
        while keys[slot] >= 0:
            slot += 1
        keys[slot], to[slot] = k, nxt
    lens = np.array([len(x) for x in spelt], np.int64)
    return {"class_of": class_of, "width": np.array(width), "bits": np.array(bits), "keys": keys, "to": to,
            "term": np.array(term, np.int32), "weight": np.array(weight), "byte_id": byte_id,
            "byte_weight": np.array((2.0 + size) ** -alpha), "spelt": np.frombuffer(b"".join(spelt), np.uint8),
            "spelt_at": np.concatenate([[0], np.cumsum(lens)])}


def _step(t: dict, node: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Trie child of each (node, class), or -1."""
    k = node.astype(np.int64) * int(t["width"]) + c
    slot = ((k.view(np.uint64) * _U(0x9E3779B97F4A7C15)) >> _U(64 - int(t["bits"]))).astype(np.int64)
    out = np.full(len(k), -1, np.int32)
    open_ = np.arange(len(k))
    while len(open_):
        found = t["keys"][slot]
        hit = found == k
        out[open_[hit]] = t["to"][slot[hit]]
        go = ~hit & (found >= 0)
        open_, k, slot = open_[go], k[go], slot[go] + 1
    return out


class Lattice:
    """Distributions of the last piece at every position, for the distinct
    chunks of one length: ``cdf`` and ``piece`` have a row for each (chunk,
    end position) and a column for each piece length."""

    def __init__(self, t: dict, points: np.ndarray):
        n, size = points.shape
        most = min(LONGEST, size)
        cls = t["class_of"][points]
        weight = np.zeros((size + 1, most + 1, n), np.float32)
        piece = np.zeros((n, size + 1, most), np.int32)
        for s in range(size):
            rows, node = np.arange(n), np.zeros(n, np.int32)
            for length in range(1, min(most, size - s) + 1):
                c = cls[rows, s + length - 1]
                node = _step(t, node, c)
                on = (node >= 0) & (c > 0)
                rows, node = rows[on], node[on]
                if not len(rows):
                    break
                ends = t["term"][node]
                is_piece = ends >= 0
                at = rows[is_piece]
                weight[s + length, length, at] = t["weight"][node[is_piece]]
                piece[at, s + length, length - 1] = ends[is_piece]
            alone = np.flatnonzero(weight[s + 1, 1] == 0)  # spelt in bytes: the code point, negated
            weight[s + 1, 1, alone] = t["byte_weight"]
            piece[alone, s + 1, 0] = -points[alone, s].astype(np.int32) - 1
        total = np.zeros((size + 1, n))
        total[0] = 1.0
        cdf = np.ones((n, size + 1, most), np.float32)  # columns of impossible lengths stay 1
        for p in range(1, size + 1):
            last = min(most, p)
            runs = np.cumsum([total[p - length] * weight[p, length] for length in range(1, last + 1)], axis=0)
            run = total[p] = runs[-1]
            cdf[:, p, :last] = (runs / run).T  # exactly 1 from the longest piece on, and u < 1
            if p % LONGEST == 0:  # only ratios matter: keep the sums in range
                total[max(0, p - LONGEST):p + 1] /= run
        self.cdf, self.piece = cdf.reshape(-1, most), piece.reshape(-1)
        self.size, self.most = size, most

    def sample(self, row: np.ndarray, key: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Backward steps: (occurrence numbers still open, piece chosen)."""
        at = np.arange(len(row))
        pos = np.full(len(row), self.size, np.int64)
        step = 0
        while len(at):
            u = (mix64(key + _U((step + 1) * 0xD1B54A32D192ED03 % (1 << 64))) >> _U(40)).astype(np.float32) * np.float32(2.0 ** -24)
            state = row * (self.size + 1) + pos
            length = 1 + (self.cdf[state] <= u[:, None]).sum(axis=1)
            yield at, self.piece[state * self.most + length - 1]
            pos = pos - length
            go = pos > 0
            at, row, key, pos = at[go], row[go], key[go], pos[go]
            step += 1


def encode(t: dict, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sampled piece ids of the texts, one after the other, and offsets."""
    index: dict[str, int] = defaultdict()
    index.default_factory = index.__len__
    parts, counts = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            chunks = CHUNK.findall(" " + text)
            counts[i] = len(chunks)
            parts.append(np.fromiter(map(index.__getitem__, chunks), np.int64, len(chunks)))
    if not parts:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    kind = np.concatenate(parts)
    doc = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(kind)) - np.repeat(np.cumsum(counts) - counts, counts)
    key = mix64(mix64(keys.astype(np.int64).view(np.uint64) + _U(0x51ED27))[doc] + number.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    names = np.array(list(index), dtype=object)
    size = np.fromiter(map(len, index), np.int64, len(index))
    place = np.zeros(len(size), np.int64)  # row of a chunk among those of its length
    order = np.argsort(size, kind="stable")
    cut = np.flatnonzero(np.diff(size[order])) + 1
    occurrence = np.argsort(size[kind], kind="stable")
    occ_cut = np.searchsorted(size[kind][occurrence], size[order[np.concatenate([[0], cut])]])
    n_pieces = np.zeros(len(kind), np.int64)
    steps = []
    groups = np.split(order, cut)
    for g, group in enumerate(groups):
        place[group] = np.arange(len(group))
        own = occurrence[occ_cut[g]:occ_cut[g + 1] if g + 1 < len(groups) else None]
        row, length = place[kind[own]], int(size[group[0]])
        rows = max(1, CELLS // (length * min(length, LONGEST)))
        for lo in range(0, len(group), rows):  # lattices of bounded size
            mine = own[(row >= lo) & (row < lo + rows)] if len(group) > rows else own
            points = np.frombuffer("".join(names[group[lo:lo + rows]]).encode("utf-32-le"), np.uint32).reshape(-1, length)
            for k, (at, piece) in enumerate(Lattice(t, points).sample(place[kind[mine]] - lo, key[mine])):
                steps.append((mine[at].astype(np.int32), k, piece))
                n_pieces[mine[at]] += 1
    end = np.cumsum(n_pieces)
    out = np.zeros(int(end[-1]), np.int32)
    for at, k, piece in steps:
        out[end[at] - 1 - k] = piece
    per_doc = np.concatenate([[0], np.cumsum(np.bincount(doc, weights=n_pieces, minlength=len(texts)).astype(np.int64))])
    spelt = np.flatnonzero(out < 0)
    if len(spelt):  # characters without a piece become byte pieces
        raw = [chr(-int(x) - 1).encode() for x in out[spelt]]
        many = np.ones(len(out), np.int64)
        many[spelt] = [len(r) for r in raw]
        start = np.cumsum(many) - many
        wide = np.repeat(out, many)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        where = np.repeat(start[spelt], many[spelt]) + np.arange(len(flat)) - np.repeat(np.cumsum(many[spelt]) - many[spelt], many[spelt])
        wide[where] = t["byte_id"][flat]
        per_doc = np.append(start, len(wide))[per_doc]
        out = wide
    return out, per_doc


def decode(t: dict, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts the ids spell, without the leading space."""
    at = t["spelt_at"]
    n = at[ids + 1] - at[ids]
    end = np.cumsum(n)
    where = np.repeat(at[ids] - (end - n), n) + np.arange(int(end[-1]) if len(end) else 0)
    data = t["spelt"][where]
    off = np.concatenate([[0], end])[offsets]
    first = off[:-1][np.diff(off) > 0]
    data = np.delete(data, first)
    return data, off - np.concatenate([[0], np.cumsum(np.diff(off) > 0)])


def _encode_task(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = sent.value
        for b in batches:
            keys = b.column("k").to_numpy(zero_copy_only=False)
            for s in slices(b.column("text"), SLICE):
                texts = b.column("text").slice(s.lo, s.n).to_pylist()
                ids, off = encode(t, texts, keys[s.lo:s.hi])
                back, back_off = decode(t, ids, off)
                same = np.diff(back_off) == np.diff(s.start)
                if same.all():
                    wrong = np.concatenate([[0], np.cumsum(back != s.data)])
                    same = wrong[s.start[1:]] == wrong[s.start[:-1]]
                else:
                    same = np.array([back[back_off[i]:back_off[i + 1]].tobytes() == s.data[s.start[i]:s.start[i + 1]].tobytes() for i in range(s.n)])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(s.lo, s.n), pa.array(np.diff(off)), pa.array(np.diff(s.start)), pa.array(same),
                     pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids))],
                    names=["doc_id", "n_pieces", "n_bytes", "lossless", "ids"])
    return run


def sample_pieces(docs: DataFrame, model: str = MODEL, alpha: float = 0.7) -> DataFrame:
    """doc_id, n_pieces, n_bytes, lossless (the ids decode to the very text)
    and the sampled ids of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(load_tables(model, alpha))
    src = docs.select("doc_id", F.coalesce("doc_id", F.lit(-1)).alias("k"), F.coalesce("text", F.lit("")).alias("text"))
    return src.mapInArrow(_encode_task(sent), "doc_id long, n_pieces long, n_bytes long, lossless boolean, ids array<int>")


def op2_piece_sampling(spark, sf_dir: str) -> DataFrame:
    return sample_pieces(read_docs(spark, sf_dir, "doc_id", "text"))
