import hashlib
import random
import re

import numpy as np
import pytest

from quiver.llm import fill_middle as f
from helpers import ODD, by_id, docs, empty, words

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@pytest.mark.parametrize("make", [lambda r: range(0, 200000), lambda r: sorted(r.sample(range(1 << 20), 300)),
                                  lambda r: sorted(r.sample(range(1 << 18), 90000)), lambda r: [5], lambda r: [],
                                  lambda r: sorted({*range(70000, 140000), *r.sample(range(1 << 22), 5000)})])
def test_select_finds_the_kth_member(make):
    values = np.array(list(make(random.Random(3))), np.int64)
    s = f.BoundarySet(values)
    k = np.random.default_rng(1).permutation(len(values))
    assert len(s) == len(values) and (s.select(k) == values[k]).all()


def test_container_kinds():
    kind = lambda v: f.Container(np.array(v, np.uint16)).kind
    assert kind(range(100, 60000)) == "run" and kind(range(0, 8000, 2)) == "array"
    assert kind(range(0, 60000, 2)) == "bitmap" and kind(range(65536)) == "run" and kind([3, 9]) == "array"


def brute(doc_id, text, units, rate=50):
    text = text or ""
    t = units(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, z = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    p, m, s = "".join(t[:a]), "".join(t[a:z]), "".join(t[z:])
    if not text or any(x in text for x in f.MARKS) or h3 % 100 >= rate:
        return len(t), "plain", None, None, text
    form = "spm" if h4 % 100 < 80 else "psm"
    return len(t), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit,units", [("token", TOKEN.findall), ("char", list)])
def test_brute_force(spark, unit, units):
    r = random.Random(2)
    texts = [*ODD, "ends with space \n", "  lead", "a<M>b", "<", "x<" * 50, "😀 é b c", "big " * 60000,
             *["".join(r.choice("ab é\t\n<P>漢") for _ in range(r.randrange(80))) for _ in range(300)], *[words(r, 90) for _ in range(30)]]
    d = docs(spark, texts)
    got = f.fill_in_middle(d, unit=unit, rate=90)
    rows = {x["doc_id"]: x for x in got.withColumn("back", f.restored(got["output"], got["form"])).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        x = rows[i]
        assert (x["n"], x["form"], x["prefix_chars"], x["middle_chars"], x["output"]) == brute(i, t, units, 90), i
        assert x["back"] == (t or "")
    assert {x["form"] for x in rows.values()} == {"plain", "psm", "spm"}


def test_defined_results(spark):
    assert f.fill_in_middle(empty(spark)).count() == 0
    d = spark.createDataFrame([(None, "some text here"), (7, "twice"), (7, "twice")], "doc_id long, text string")
    got = sorted(map(tuple, f.fill_in_middle(d).collect()), key=str)
    assert got == sorted([(i, *brute(i, t, TOKEN.findall)) for i, t in [(None, "some text here"), (7, "twice"), (7, "twice")]], key=str)
    for marks in (("aba", "<S>", "<M>"), ("<P>", "<P>", "<M>"), ("", "<S>", "<M>")):
        with pytest.raises(ValueError):
            f.fill_in_middle(d, marks=marks)
    assert by_id(f.fill_in_middle(docs(spark, ["a b"])), "n") == {0: (2,)}
