"""Operator 10: secret scans, a character convolutional network over every
candidate and its surroundings.

One scan of the whole texts finds the base findings (three patterns) and the
candidates: runs of ``[A-Za-z0-9+/_.=-]`` without the dots at their ends, of
``MIN_RUN`` characters with a digit or with capitals among small letters (not
only the first letter), or of ``LONG_RUN`` characters; a shorter run of letters
of one case is a word.  Labelled findings train the network: a
candidate holding a base finding's secret is positive, the others negative
(account numbers, long words and the like).  Three quarters of all candidates,
chosen by a hash, train: dealt into shards, each shard goes through its own
candidates once an epoch, and the shards' parameters are averaged between
epochs.  All others calibrate the scores (Platt) and fix the threshold: the
largest that keeps ``recall`` of the labelled secrets, whatever precision that
costs (``Network.precision`` tells, on the same rows).  Every candidate of every
document is then scored, long ones in overlapping windows, and those above
the threshold that no base finding covers are added as kind ``cnn``.

Edge cases: null and empty texts have no findings; repeated documents are
returned as often as they occur; without positive or negative candidates
nothing is trained and only base findings are returned; an empty table gives
an empty result.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, read_docs, slices

ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "cnn")
MIN_RUN, LONG_RUN = 6, 24

LEFT, BODY, RIGHT = 20, 40, 12
WIDTH = LEFT + BODY + RIGHT
_U = np.uint64


def _class(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_RUN = _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
_HEX = _class(b"0123456789abcdef")
_DIGIT = _class(b"0123456789")
_UPPER = _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _class(b"abcdefghijklmnopqrstuvwxyz")
_DOT = ord(".")


def _runs(member: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of maximal runs, cut at document starts."""
    first = member.copy()
    first[1:] &= ~member[:-1]
    edge = start[:-1][np.diff(start) > 0]
    first[edge] = member[edge]
    last = member.copy()
    last[:-1] &= ~member[1:]
    last[edge[1:] - 1] = member[edge[1:] - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _trimmed(lo: np.ndarray, hi: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs from their first to their last byte listed in ``inner`` (sorted);
    runs without one are gone."""
    first, last = np.searchsorted(inner, lo), np.searchsorted(inner, hi) - 1
    some = first <= last
    return inner[first[some]], inner[last[some]] + 1


def _find(s) -> tuple[list, list]:
    """Base findings (row, kind, start, end; bytes in the slice) and
    candidates (row, start, end)."""
    data, raw = s.data, s.data.tobytes()
    low = raw.lower()
    base = []
    rows = set()
    for word in KEYWORDS:
        at = low.find(word)
        while at >= 0:
            row = int(np.searchsorted(s.start, at, "right")) - 1
            rows.add(row)
            at = low.find(word, int(s.start[row + 1]))  # one hit sends the whole document to the pattern
    for row in rows:
        lo = int(s.start[row])
        for m in ASSIGN.finditer(raw[lo:int(s.start[row + 1])]):
            if m.end(2) - m.start(2) >= 6:
                base.append((row, 0, lo + m.start(), lo + m.end(), lo + m.start(2)))
    if b"AKIA" in raw:
        for row in range(s.n):
            lo = int(s.start[row])
            text = raw[lo:int(s.start[row + 1])]
            if b"AKIA" in text:
                base += [(row, 1, lo + m.start(), lo + m.end(), lo + m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    lo, hi = _runs(_HEX[data], s.start)
    long = hi - lo >= 24
    doc = s.doc
    base += [(int(doc[a]), 2, int(a), int(b), int(a)) for a, b in zip(lo[long], hi[long], strict=True)]
    member = _RUN[data]
    lo, hi = _trimmed(*_runs(member, s.start), np.flatnonzero(member & (data != _DOT)))
    digits, upper, lower = (np.concatenate([[0], np.cumsum(kind[data])]) for kind in (_DIGIT, _UPPER, _LOWER))
    n = hi - lo
    mixed = (upper[hi] > upper[np.minimum(lo + 1, hi)]) & (lower[hi] > lower[lo])
    ok = (n >= MIN_RUN) & ((digits[hi] > digits[lo]) | mixed | (n >= LONG_RUN))
    return base, list(zip(doc[lo[ok]].tolist(), lo[ok].tolist(), hi[ok].tolist(), strict=True))


def windows(raw: bytes, lo: int, hi: int, start: int, end: int) -> list[bytes]:
    """The candidate with its context, cut into overlapping windows of BODY
    bytes; each is LEFT + BODY + RIGHT bytes, zero where there is nothing."""
    out = []
    for a in range(lo, max(lo + 1, hi - 8), BODY - 8):
        b = min(hi, a + BODY)
        left = raw[max(start, a - LEFT):a].rjust(LEFT, b"\0")
        out.append(left + raw[a:b].ljust(BODY, b"\0") + raw[b:min(end, b + RIGHT)].ljust(RIGHT, b"\0"))
    return out


FOUND = ("doc_id long, n_assign long, n_access long, n_hex long, base array<struct<k:int,s:long,e:long>>, "
         "cands array<struct<s:long,e:long,y:int,w:array<binary>>>")


_FOUND_TYPE = pa.schema([
    ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
    ("base", pa.list_(pa.struct([("k", pa.int32()), ("s", pa.int64()), ("e", pa.int64())]))),
    ("cands", pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("y", pa.int32()), ("w", pa.list_(pa.binary()))])))])


def _scan_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for s in slices(b.column("text")):
            base, cands = _find(s)
            raw = s.data.tobytes()
            chars = np.concatenate([[0], np.cumsum((s.data & 0xC0) != 0x80)])
            counts = np.zeros((3, s.n), np.int64)
            found: list[list] = [[] for _ in range(s.n)]
            secret: list[list] = [[] for _ in range(s.n)]
            for row, kind, lo, hi, value in sorted(base, key=lambda x: (x[0], x[2], x[1])):
                counts[kind, row] += 1
                d = chars[s.start[row]]
                found[row].append({"k": kind, "s": int(chars[lo] - d), "e": int(chars[hi] - d)})
                secret[row].append((value, hi))
            held: list[list] = [[] for _ in range(s.n)]
            for row, lo, hi in cands:
                d = chars[s.start[row]]
                y = int(any(a < hi and lo < z for a, z in secret[row]))
                held[row].append({"s": int(chars[lo] - d), "e": int(chars[hi] - d), "y": y,
                                  "w": windows(raw, lo, hi, int(s.start[row]), int(s.start[row + 1]))})
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(s.lo, s.n), *(pa.array(c) for c in counts),
                 pa.array(found, _FOUND_TYPE.field("base").type), pa.array(held, _FOUND_TYPE.field("cands").type)],
                schema=_FOUND_TYPE)


def scan(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_scan_task, FOUND)


class Network:
    """Embedding -> width-5 convolution -> ReLU -> max over body and over
    context -> logistic unit; plain numpy, trained with Adam."""

    EMB, FILTERS, K = 8, 24, 5

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {"emb": r.normal(0, 0.3, (128, self.EMB)).astype(np.float32),
                  "conv": r.normal(0, 0.15, (self.K * self.EMB, self.FILTERS)).astype(np.float32),
                  "bias": np.zeros(self.FILTERS, np.float32),
                  "out": r.normal(0, 0.2, 2 * self.FILTERS).astype(np.float32), "b": np.zeros(1, np.float32)}
        self.platt = (1.0, 0.0)
        self.threshold = 2.0  # nothing passes until trained
        self.precision = 0.0

    @staticmethod
    def codes(rows: list[bytes]) -> np.ndarray:
        x = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, WIDTH)
        return np.where(x < 127, x, 127)

    def _forward(self, x):
        p, n = self.p, len(x)
        e = p["emb"][x]
        e = np.pad(e, ((0, 0), (2, 2), (0, 0)))
        cols = np.concatenate([e[:, k:k + WIDTH] for k in range(self.K)], axis=2)
        a = np.maximum(cols.reshape(n * WIDTH, -1) @ p["conv"] + p["bias"], 0).reshape(n, WIDTH, -1)
        body, rest = a[:, LEFT:LEFT + BODY], np.concatenate([a[:, :LEFT], a[:, LEFT + BODY:]], axis=1)
        ib, ir = body.argmax(1), rest.argmax(1)
        h = np.concatenate([np.take_along_axis(body, ib[:, None], 1)[:, 0], np.take_along_axis(rest, ir[:, None], 1)[:, 0]], axis=1)
        return cols, a, ib, ir, h, h @ p["out"] + p["b"][0]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i:i + 512])[-1] for i in range(0, len(x), 512)]) if len(x) else np.zeros(0)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, rate: float = 0.01, batch: int = 128) -> None:
        state = self.start()
        for epoch in range(epochs):
            state = self.epoch(x, y, y.mean(), state, epoch, rate, batch)

    def start(self) -> tuple[dict, dict, int]:
        """Adam's moments and step."""
        return {k: np.zeros_like(v) for k, v in self.p.items()}, {k: np.zeros_like(v) for k, v in self.p.items()}, 0

    def epoch(self, x: np.ndarray, y: np.ndarray, share: float, state: tuple[dict, dict, int], epoch: int,
              rate: float = 0.01, batch: int = 128) -> tuple[dict, dict, int]:
        """Once through the rows; ``share`` is that of label 1 in all rows."""
        r = np.random.default_rng(11)
        for _ in range(epoch + 1):
            shuffled = r.permutation(len(x))
        m, v, t = state
        weight = np.where(y == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
        for at in np.array_split(shuffled, max(1, len(x) // batch)):
            cols, a, ib, ir, h, z = self._forward(x[at])
            d = ((1 / (1 + np.exp(-z)) - y[at]) * weight[at] / len(at)).astype(np.float32)
            g = {"out": h.T @ d, "b": np.array([d.sum()], np.float32)}
            dh = d[:, None] * self.p["out"]
            da = np.zeros_like(a)
            i, f = np.arange(len(at))[:, None], np.arange(self.FILTERS)[None]
            np.add.at(da, (i, LEFT + ib, f), dh[:, :self.FILTERS])
            np.add.at(da, (i, np.where(ir < LEFT, ir, ir + BODY), f), dh[:, self.FILTERS:])
            da *= a > 0
            flat = da.reshape(-1, self.FILTERS)
            g["conv"], g["bias"] = cols.reshape(len(flat), -1).T @ flat, flat.sum(0)
            dc = (flat @ self.p["conv"].T).reshape(len(at), WIDTH, self.K, self.EMB)
            de = np.zeros((len(at), WIDTH + 4, self.EMB), np.float32)
            for k in range(self.K):
                de[:, k:k + WIDTH] += dc[:, :, k]
            g["emb"] = np.zeros_like(self.p["emb"])
            np.add.at(g["emb"], x[at], de[:, 2:-2])
            t += 1
            for k in self.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-7)).astype(np.float32)
        return m, v, t

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float) -> None:
        """Platt scaling on a held-out sample; the threshold is the largest
        score that keeps ``recall`` of its secrets."""
        z = self.raw(x)
        a, c = 1.0, 0.0
        for _ in range(50):  # Newton steps on two parameters
            p = 1 / (1 + np.exp(-np.clip(a * z + c, -30, 30)))
            w, e = p * (1 - p) + 1e-9, p - y
            H = np.array([[np.sum(w * z * z) + 1e-2, np.sum(w * z)], [np.sum(w * z), np.sum(w) + 1e-2]])
            step = np.linalg.solve(H, np.array([np.sum(e * z) + 1e-2 * (a - 1), np.sum(e) + 1e-2 * c]))
            a, c = a - np.clip(step[0], -1, 1), c - np.clip(step[1], -1, 1)
        self.platt = (float(a), float(c))
        scores = self.score(x)
        p = np.sort(scores[y == 1])
        if len(p):
            self.threshold = float(p[int(np.floor((1 - recall) * len(p)))])
            self.precision = float(np.mean(y[scores >= self.threshold]))

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated(self.raw(x))

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        a, c = self.platt
        return 1 / (1 + np.exp(-np.clip(a * raw + c, -30, 30)))


def _epoch_of(net: bytes, state: bytes, share: float, epoch: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own = Network()
        own.__dict__.update(pickle.loads(net))
        pdf = pdf.sort_values(["y", "o", "doc_id", "s"], kind="stable", na_position="first")
        after = own.epoch(own.codes([bytes(w) for w in pdf["w"]]), pdf["y"].to_numpy(), share, pickle.loads(state), epoch)
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "n": [len(pdf)], "state": [pickle.dumps((own.p, after))]})
    return run


def _averaged(rows: list) -> tuple[dict, tuple]:
    """The shards' parameters and moments, weighted by their rows."""
    n = np.array([r["n"] for r in rows], float)
    states = [pickle.loads(r["state"]) for r in rows]
    mean = lambda ds: {k: (sum(w * d[k].astype(float) for w, d in zip(n, ds, strict=True)) / n.sum()).astype(np.float32) for k in ds[0]}
    return mean([p for p, _ in states]), (mean([a[0] for _, a in states]), mean([a[1] for _, a in states]), max(a[2] for _, a in states))


def _fit(net: Network, rows: DataFrame, n: int, share: float, epochs: int, shard_rows: int, shards: int) -> None:
    """Every epoch is one job over all rows; the driver gets the shards'
    parameters (25 kB with Adam's moments, for at most ``shards``)."""
    count = min(shards, -(-n // shard_rows))
    dealt = rows.withColumn("shard", F.expr(f"cast(pmod(shiftright(o, 2), {count}) as int)"))
    state = net.start()
    for epoch in range(epochs):
        run = _epoch_of(pickle.dumps({"p": net.p}), pickle.dumps(state), share, epoch)
        done = dealt.groupBy("shard").applyInPandas(run, "shard int, n long, state binary").collect()
        net.p, state = _averaged(sorted(done, key=lambda r: r["shard"]))


def _raw_task(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network()
        net.__dict__.update(sent.value)
        for b in batches:
            z = net.raw(net.codes(b.column("w").to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(z.astype(np.float32)), b.column("y")], names=["z", "y"])
    return run


def _calibrate(net: Network, rows: DataFrame, n_secrets: int, recall: float) -> None:
    """:meth:`Network.calibrate` over all rows: Spark adds up each Newton step
    and finds the quantile."""
    sent = rows.sparkSession.sparkContext.broadcast(vars(net))
    raw = materialize(rows.select("w", "y").mapInArrow(_raw_task(sent), "z float, y int")).withColumn("z", F.col("z").cast("double"))
    a, c = 1.0, 0.0
    at = lambda: F.least(F.greatest(F.col("z") * a + c, F.lit(-30.0)), F.lit(30.0))
    for _ in range(50):
        p = raw.select("z", "y", (1 / (1 + F.exp(-at()))).alias("p")).selectExpr("z", "p * (1 - p) + 1e-9 w", "p - y e")
        r = p.selectExpr("sum(w * z * z) wzz", "sum(w * z) wz", "sum(w) w", "sum(e * z) ez", "sum(e) e").first()
        step = np.linalg.solve(np.array([[r["wzz"] + 1e-2, r["wz"]], [r["wz"], r["w"] + 1e-2]]),
                               np.array([r["ez"] + 1e-2 * (a - 1), r["e"] + 1e-2 * c]))
        a, c = float(a - np.clip(step[0], -1, 1)), float(c - np.clip(step[1], -1, 1))
        if np.abs(step).max() < 1e-9:
            break
    net.platt = (a, c)
    below = int(np.floor((1 - recall) * n_secrets))  # secrets under the threshold: the rest keep the recall
    least = raw.filter("y = 1").select(at().alias("t"), "z").orderBy("t", "z").limit(below + 1).agg(F.max(F.struct("t", "z")).alias("m")).first()["m"]
    net.threshold = float(net.calibrated(np.array([least["z"]], np.float32))[0])
    net.precision = float(raw.filter(at() >= least["t"]).agg(F.avg("y")).first()[0])


def train_network(found: DataFrame, recall: float = 0.99, epochs: int = 6, shard_rows: int = 8000, shards: int = 64) -> Network:
    """Fit on all candidates but a quarter, chosen by a hash, which calibrates.
    A shard has about ``shard_rows`` candidates, more when ``shards`` do not
    suffice."""
    net = Network()
    c = found.select("doc_id", F.explode("cands").alias("c")).select("doc_id", "c.s", "c.y", F.col("c.w")[0].alias("w"))
    c = materialize(c.select(F.xxhash64("w", "doc_id", "s").alias("o"), "doc_id", "s", "y", "w"))
    held = F.col("o") % 4 == 0
    n = {(r["held"], r["y"]): r["n"] for r in c.groupBy(held.alias("held"), "y").agg(F.count("*").alias("n")).collect()}
    if len(n) < 4:  # two labels on either side
        return net
    rows = n[False, 0] + n[False, 1]
    _fit(net, c.filter(~held), rows, n[False, 1] / rows, epochs, shard_rows, shards)
    _calibrate(net, c.filter(held), n[True, 1], recall)
    return net


def _add_task(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network()
        net.__dict__.update(sent.value)
        for b in batches:
            base, cands = b.column("base").to_pylist(), b.column("cands").to_pylist()
            flat = [w for row in cands for c in row for w in c["w"]]
            score = iter(net.score(net.codes(flat)).tolist() if flat else [])
            spans = []
            for own, row in zip(base, cands, strict=True):
                extra = []
                for c in row:
                    p = max([next(score) for _ in c["w"]])
                    if p >= net.threshold and not any(f["s"] < c["e"] and c["s"] < f["e"] for f in own):
                        extra.append({"k": 3, "s": c["s"], "e": c["e"]})
                spans.append(sorted(own + extra, key=lambda f: (f["s"], f["k"])))
            text = lambda fs: ",".join(f"{KINDS[f['k']]}:{f['s']}:{f['e']}" for f in fs)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k) for k in ("doc_id", "n_assign", "n_access", "n_hex")), pa.array([text(f) for f in base], pa.string()),
                 pa.array([text(f) for f in spans], pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans"])
    return run


def secret_spans(docs: DataFrame, recall: float = 0.99) -> DataFrame:
    """Per document: base counts, base spans and all spans, each span
    ``kind:start:end`` in code points."""
    found = materialize(scan(docs))
    sent = docs.sparkSession.sparkContext.broadcast(vars(train_network(found, recall)))
    return found.mapInArrow(_add_task(sent), "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string")


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    r = secret_spans(read_docs(spark, sf_dir, "doc_id", "text"))
    return r.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")
