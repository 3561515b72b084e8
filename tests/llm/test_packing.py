import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from quiver.llm import packing as p
from quiver.llm.vocab import BYTE_BPE, ByteBpe, file_bytes
from helpers import ODD, docs, empty, words


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(BYTE_BPE)


def test_ids_are_the_librarys(library):
    bpe, plain = ByteBpe(file_bytes(BYTE_BPE)), ByteBpe(file_bytes(BYTE_BPE), True)
    assert bpe.fast is not None
    r = random.Random(4)
    texts = ["", "a<|endoftext|> b<|endoftext|>", " " * 9000 + "x", "it's 12\n\n  3é漢 \u0085z", "\n" * 3999 + "  " * 4000,
             *["".join(chr(r.choice([r.randrange(32, 127), r.randrange(0xD7FF), 32, 10])) for _ in range(60)) for _ in range(500)]]
    for t in texts:
        library.encode_special_tokens = False
        assert bpe.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids
        library.encode_special_tokens = True
        assert plain.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids
        assert b"".join(plain.spelt[i] for i in plain.encode(t)) == t.encode()
    library.encode_special_tokens = False


def unrolled(counts, steps):
    """Contents of every sequence, in order of placing."""
    out = defaultdict(list)
    placed = defaultdict(int)
    for n, rank, k, per, seq, off in steps.tolist():
        assert k % per == 0
        for r in range(k):
            out[seq + r // per].append((off + r % per * n, n))
        assert rank == placed[n]
        placed[n] += k
    assert dict(placed) == {n: c for n, c in counts.items() if c}
    return out


def one_by_one(counts, cap, weight, rule):
    """The same rule, a piece at a time."""
    bins = []
    for n in sorted(counts, reverse=True):
        v = (n, 1, n * n)
        for _ in range(counts[n]):
            fits = [b for b in bins if all(x >= y for x, y in zip(b, v))]
            if not fits:
                bins.append(list(cap))
                fits = [bins[-1]]
            score = lambda b: tuple(sum(w * s for w, s in zip(ws, (
                [((x - y) / c) ** 2 for x, y, c in zip(b, v, cap)] if rule == "norm" else [-(x / c) * (y / c) for x, y, c in zip(b, v, cap)])))
                for ws in (weight, (1, 1, 1)))
            best = min(fits, key=score)
            best[:] = [x - y for x, y in zip(best, v)]
    return len(bins)


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("documents,attention", [(None, None), (4, None), (None, 1500), (5, 2000)])
def test_every_capacity_holds(rule, documents, attention):
    for seed in range(15):
        r = random.Random(seed)
        counts = {r.randrange(1, 39): r.randrange(1, 40) for _ in range(r.randrange(1, 25))}
        steps = p.plan_packing(counts, 64, documents, attention, rule)
        seqs = unrolled(counts, steps)
        assert sorted(seqs) == list(range(len(seqs)))
        for items in seqs.values():
            items.sort()
            assert [o for o, _ in items] == [sum(n for _, n in items[:i]) for i in range(len(items))]
            assert sum(n for _, n in items) <= 64 and len(items) <= (documents or 64)
            assert sum(n * n for _, n in items) <= (attention or 64 * 64)
        cap = (64, documents or 64, attention or 4096)
        binds = (True, cap[1] * min(counts) < 64, cap[2] < 4096)
        share = [sum((n, 1, n * n)[d] * c for n, c in counts.items()) / cap[d] for d in range(3)]
        weight = [s * b / sum(x * y for x, y in zip(share, binds)) for s, b in zip(share, binds)]
        if rule == "norm":
            assert abs(len(seqs) - one_by_one(counts, cap, weight, rule)) <= 1
        lower = max(math.ceil(s) for s, b in zip(share, binds) if b)
        assert len(seqs) >= lower


def test_few_sequences():
    r = random.Random(1)
    counts = defaultdict(int)
    for _ in range(200000):
        counts[min(2048, int(r.lognormvariate(5.5, 1.2)) + 1)] += 1
    counts[700] += 90000  # one length of a third of all pieces
    steps = p.plan_packing(counts)
    total = sum(n * c for n, c in counts.items())
    assert len(unrolled(counts, steps)) <= 1.002 * total / 2048 + 1
    assert len(steps) < 3 * 2048 * (math.sqrt(2 * 2048) + 1)


def test_defined_errors():
    assert len(p.plan_packing({})) == 0 and len(p.plan_packing({5: 0})) == 0
    for bad in (dict(counts={3: 1}, rule="other"), dict(counts={0: 1}), dict(counts={4000: 1}), dict(counts={900: 1}, attention=1000)):
        with pytest.raises(ValueError):
            p.plan_packing(**bad)


def test_documents_come_back_whole(spark, library, monkeypatch):
    monkeypatch.setattr(p, "GROUP", 7)  # salts in a small table
    r = random.Random(5)
    texts = [*ODD, *[words(r, r.randrange(1, 400)) for _ in range(150)], *["same text"] * 60, "long " * 30000, "a<|endoftext|>b"]
    d = docs(spark, texts)
    packed = p.pack(d, tokens=128, documents=9)
    rows = packed.collect()
    by_doc = defaultdict(list)
    for x in rows:
        assert x["length"] == len(x["ids"]) and x["ids_crc32"] == zlib.crc32(np.array(x["ids"], "<u4").tobytes())
        by_doc[x["doc_id"]].append(x)
    assert len(by_doc) == len(texts)
    for i, t in enumerate(texts):
        mine = sorted(by_doc[i], key=lambda x: x["piece"])
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        assert [k for x in mine for k in x["ids"]] == ids
        assert [x["piece"] for x in mine] == list(range(len(mine)))
        assert [x["start"] for x in mine] == [sum(y["length"] for y in mine[:k]) for k in range(len(mine))]
        assert all(x["length"] == 128 for x in mine[1:]) and 1 <= mine[0]["length"] <= 128
    by_seq = defaultdict(list)
    for x in rows:
        by_seq[x["sequence_id"]].append((x["offset"], x["length"], x["ids"]))
    for items in by_seq.values():
        items.sort()
        assert [o for o, _, _ in items] == [sum(n for _, n, _ in items[:k]) for k in range(len(items))]
        assert sum(n for _, n, _ in items) <= 128 and len(items) <= 9
    got = {x["sequence_id"]: x["ids"] for x in p.sequences(packed).collect()}
    assert got == {s: [k for _, _, ids in sorted(items) for k in ids] for s, items in by_seq.items()}
    total = sum(x["length"] for x in rows)
    assert len(by_seq) <= max(1.1 * total / 128, 1.1 * len(rows) / 9) + 2


def test_empty_null_and_repeated(spark):
    assert p.pack(empty(spark)).count() == 0
    d = spark.createDataFrame([(None, None), (None, "x"), (3, "y z"), (3, "y z")], "doc_id long, text string")
    rows = sorted(p.pack(d).collect(), key=lambda x: x["offset"])
    assert len(rows) == 4 and len({x["sequence_id"] for x in rows}) == 1
    assert sorted(x["length"] for x in rows) == [1, 2, 3, 3]
