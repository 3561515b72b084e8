import random

import numpy as np

from quiver.llm import near_dedup as q
from quiver.llm.graph import components
from helpers import ODD, by_id, docs, empty, words


def brute(texts, k):
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    sets = []
    for t in texts:
        w = (t or "").translate(low).encode().split()
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


def test_components_equal_brute_force(spark):
    r = random.Random(2)
    base = [words(r, 60).split() for _ in range(6)]
    texts = list(ODD)
    for _ in range(110):
        b = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 4, 9])):
            b[r.randrange(len(b))] = f"z{r.randrange(9)}"
        texts.append(" ".join(b) if r.random() < 0.7 else " ".join(b).upper())
    for k in (4, 5):
        assert by_id(q.duplicate_classes(docs(spark, texts), k, 80), "n_shingles", "component_id") == brute(texts, k)


def test_one_of_each_group_stays(spark):
    t = words(random.Random(3), 40)
    d = docs(spark, [t, t, "other text here", t + " end", None])
    kept = q.near_dedup(d.union(d.filter("doc_id = 2")))
    assert kept.columns == d.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 4]
    assert q.near_dedup(empty(spark)).count() == 0
    nameless = spark.createDataFrame([(None, t), (None, t), (1, t)], "doc_id long, text string")
    assert q.near_dedup(nameless).count() == 3


def test_estimates_follow_jaccard():
    r = np.random.default_rng(1)
    a, b = q._functions()
    err = []
    for _ in range(40):
        both, x, y = (r.integers(0, 1 << 63, n).astype(np.uint64) for n in (400, 50, 50))
        one, two = np.concatenate([both, x]), np.concatenate([both, y])
        j = q.estimate(q.sketch(one, a, b)[None], q.sketch(two, a, b)[None], np.array([450.0]), np.array([450.0]))[0]
        err.append(j - 0.8)
        assert (q.sketch(np.concatenate([one, two]), a, b) == np.maximum(q.sketch(one, a, b), q.sketch(two, a, b))).all()
    assert abs(np.mean(err)) < 0.02 and np.std(err) < 0.06


def test_component_labels(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(50, k) for k in range(51, 80)] + [(90, 91), (91, 90), (95, 95)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 31)}, **{k: 50 for k in range(50, 80)}, 90: 90, 91: 90}
