"""Small inputs shared by the tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, name string, row string, uid long, _hits string"


def docs(spark, texts, langs=None):
    """Documents 0.. with extra columns named like the operators' own."""
    rows = [(i, t, (langs or ["en"] * len(texts))[i], "s", len(t or ""), "n", "r", -i, "h") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(r: random.Random, n: int, vocab: int = 200) -> str:
    return " ".join("w" + "aeiou"[k % 5] + "klmnp"[k // 5 % 5] + str(k) for k in (r.randrange(vocab) for _ in range(n)))


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


#: null, empty, blank, control and wide characters, a very long text, a repeated one
ODD = [None, "", " \n\t ", "é ñ \x00b", "▁ a▁b", "x" * 3000, "tie tie tie", "tie tie tie", "word " * 4000]
