import hashlib
import random

from quiver.llm import reply_trees as q

MSG = "tree_id long, node_id long, parent_id long, role string, text string, score double"


def paths(rows):
    """Root-to-leaf paths by brute force: {tree: [(score, texts)]}."""
    out = {}
    for t in {r[0] for r in rows}:
        own = {r[1]: r for r in rows if r[0] == t and r[1] is not None}
        kids = {}
        for r in own.values():
            kids.setdefault(r[2] if r[2] in own else None, []).append(r[1])

        def walk(n, texts, score):
            r = own[n]
            texts, score = [*texts, (r[3] or "", r[4] or "")], score + (r[5] or 0)
            if n not in kids:
                out.setdefault(t, []).append((round(score, 6), texts))
            for k in kids.get(n, []):
                walk(k, texts, score)
        for root in kids.get(None, []):
            walk(root, [], 0)
    return {t: sorted(p) for t, p in out.items()}


def read(df):
    out = {}
    for r in q.read_back(df).collect():
        out.setdefault(r["tree_id"], []).append((round(r["score"], 6), [(t["role"], t["text"]) for t in r["turns"]]))
    return {t: sorted(p) for t, p in out.items()}


def test_paths_equal_brute_force(spark):
    r = random.Random(4)
    rows = []
    for t in range(12):
        for n in range(r.randrange(1, 25)):
            rows.append((t, n, r.randrange(n) if n and r.random() < 0.95 else None, r.choice(["user", "assistant", None, "a%\nb<|"]),
                         r.choice([None, "", "<|im_end|>", "<\\|x", "hi\nthere %0A", "é" * 5]), r.choice([None, 0.5, 1.0, 2.0])))
    rows += [(50, n, n - 1 if n else None, "user", str(n), 1.0) for n in range(70)]  # a long chain
    rows += [(51, 1, 99, "user", "orphan", 0.0), (52, 1, 2, "user", "cycle", 0.0), (52, 2, 1, "user", "cycle", 0.0),
             (53, None, None, "user", "no id", 0.0), (None, 1, None, "user", "no tree", 0.0)]
    got = read(q.format_trees(spark.createDataFrame(rows, MSG).repartition(4)))
    want = paths(rows)
    want.pop(52, None)
    assert got == want


def test_best_branches(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", -1.0), (1, 3, 1, "assistant", "good", 5.0), (1, 4, 1, "assistant", "fair", 1.0)]
    got = q.format_trees(spark.createDataFrame(rows + rows, MSG), top=2).orderBy("path_rank").collect()
    assert [x["score"] for x in got] == [5.0, 1.0] and "good" in got[0]["formatted"]
    f = got[0]
    assert [f["formatted"][s["start"]:s["start"] + s["length"]] for s in f["loss"]] == ["good"]
    assert q.format_trees(spark.createDataFrame([], MSG)).count() == 0


def test_conversations_with_ties_and_nulls(spark):
    rows = [(1, 2, "assistant", None), (1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (None, None, None, "x"), (2, 0, "assistant", "<|")]
    c = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = read(q.format_trees(q.conversation_trees(c)))
    assert got == {1: [(0.0, [("user", "a"), ("user", "a"), ("user", "b"), ("assistant", "")])], None: [(0.0, [("", "x")])], 2: [(0.0, [("assistant", "<|")])]}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["conv_id"]: r for r in q.op3_reply_trees(spark, sf).collect()}
    rows = sorted(spark.read.parquet(f"{sf}/conversations.parquet").collect(), key=lambda r: (r["conv_id"], r["turn"]))
    assert len(got) == len({r["conv_id"] for r in rows}) + 1
    for i in list(got)[:20]:
        own = [(r["role"], r["text"]) for r in rows if r["conv_id"] == i] if i != -1 else [(x, "<|im_end|><|im_start|>assistant ok") for x in ("user", "assistant")]
        said = "".join(t for x, t in own if x == "assistant")
        assert got[i]["turns_sha256"] == hashlib.sha256("".join(f"{x}\n{t}\n" for x, t in own).encode()).hexdigest()
        assert (got[i]["loss_chars"], got[i]["loss_sha256"], got[i]["n_turns"]) == (len(said), hashlib.sha256(said.encode()).hexdigest(), len(own))
