import hashlib
import random
from collections import Counter

import pytest

from quiver.llm import alignment as al
from helpers import ODD, docs, empty, words

COLS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_alphabet():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {chr(b): b for b in shown}, 256
    for b in range(256):
        if b not in shown:
            out[chr(extra)] = b
            extra += 1
    return out


@pytest.fixture(scope="module")
def brute():
    """Rows by the two libraries and plain loops."""
    import sentencepiece
    from tokenizers import Tokenizer
    ta = Tokenizer.from_file(al.BYTE_BPE)
    ta.encode_special_tokens = True
    tb = sentencepiece.SentencePieceProcessor(model_file=al.PIECE_BPE)
    alphabet = byte_alphabet()

    def tokens(text):
        if not text:
            return [], []
        a = ta.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(alphabet[c] for c in t)) for i, t in zip(a.ids, a.tokens)]
        b = [(i, bytes([int(tb.id_to_piece(i)[3:5], 16)]) if tb.is_byte(i) else tb.id_to_piece(i).replace("▁", " ").encode()) for i in tb.encode(text)]
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])

    def run(texts):
        links, shapes = [], []
        for text in texts:
            a, b = tokens(text)
            groups, mine, i, j = [], [], 0, 0
            while i < len(a):
                ga, gb, ea, eb = [], [], 0, 0
                while not ga or ea != eb:
                    if ea <= eb:
                        ga.append(a[i][0])
                        ea += len(a[i][1])
                        i += 1
                    else:
                        gb.append(b[j][0])
                        eb += len(b[j][1])
                        j += 1
                groups.append((ga, gb))
                mine.append((ga[-1], gb[-1]))
            links.append(mine)
            shapes.append((len(a), len(b), groups))
        count = Counter(p for mine in links for p in mine)
        best = Counter()
        for (a, b), n in count.items():
            best[b] = max(best[b], n)
        out = []
        for (na, nb, groups), mine in zip(shapes, links):
            s = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
            out.append((na, nb, len(groups), len(mine), sum(count[p] == best[p[1]] for p in mine), sum(count[p] for p in mine),
                        hashlib.sha256(s.encode()).hexdigest() if groups else ""))
        return out
    return run


def test_brute_force(spark, brute, monkeypatch):
    monkeypatch.setattr(al, "CHUNK", 3000)  # many chunks in a small table
    monkeypatch.setattr(al, "STEP", 700)
    r = random.Random(8)
    texts = [*ODD, "<|endoftext|> </s><s>", "<unk>", "ﬁ ½ ① Å", " lead and trail ", "tab\tand\r\nline", "漢字かな 😀🏽", "a▁b", " x　y", " " * 5000,
             *[words(r, r.randrange(1, 120)) for _ in range(120)], *["the same text again"] * 40,
             *["".join(chr(r.choice([r.randrange(32, 127), r.randrange(0x2FF), r.randrange(0xD7FF), 32])) for _ in range(40)) for _ in range(60)]]
    want = brute(texts)
    assert any(w[0] == 0 for w, t in zip(want, texts) if t)  # one that is not spelt exactly
    got = {x["doc_id"]: tuple(x[c] for c in COLS) for x in al.align_tokenizers(docs(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        assert got[i] == w, (i, texts[i])


def test_given_table(spark, brute):
    t = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = t.collect()
    want = dict(zip([x["doc_id"] for x in rows], brute([x["text"] for x in rows])))
    got = {x["doc_id"]: tuple(x[c] for c in COLS) for x in al.align_tokenizers(t).collect()}
    assert got == want


def test_defined_results(spark, brute):
    assert al.align_tokenizers(empty(spark)).count() == 0
    d = spark.createDataFrame([(None, "a b"), (None, "a b"), (2, None), (2, "")], "doc_id long, text string")
    got = sorted((tuple(x[c] for c in COLS) for x in al.align_tokenizers(d).collect()))
    assert got == sorted(brute(["a b", "a b", None, ""]))
