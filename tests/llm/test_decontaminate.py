import random

from quiver.llm import decontaminate as q
from helpers import ODD, docs, empty

ITEM = "Then John bought 12 apples for 3 kg of rice and gave John 4 pears to Mary before the long day ended."


def items(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts, 1)), "item_id long, text string")


def test_reparameterised_questions(spark):
    texts = ["Some words first. " + ITEM + " Tail.",
             "Intro. Then Paul bought 15 apples for 7 lb of rice and gave Paul 9 pears to Anna before the long day ended.",
             "Then Paul bought 15 apples for 7 lb of rice and gave Peter 9 pears to Anna before the long day ended.",  # one name, two values
             "Then John, went home with nothing at all to eat", ITEM.replace(" ", "\n  "), *ODD]
    d = docs(spark, texts)
    found = {(r["doc_id"], r["item_id"]) for r in q.contamination(d, items(spark, ITEM, None, "", "short", "tie tie tie tie")).collect()}
    assert found == {(0, 1), (1, 1), (4, 1)}
    kept = q.remove_contaminated(d, items(spark, ITEM))
    assert kept.columns == d.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, *range(5, len(texts))]


LONG = ("a trader in New York sold rice for $1,200 and later paid 3.5 dollars for every small bag that "
        "was carried over the hill to him")


def test_values_of_another_length(spark):
    d = docs(spark, [LONG.replace("New York", "Paris").replace("$1,200", "300").replace("3.5", "4"),
                     LONG.replace("New York", "Anne-Marie O'Hara Smith").replace("$1,200", "-1,234,567.89").replace("3.5", ".25")])
    found = {(r["doc_id"], r["share"]) for r in q.contamination(d, items(spark, LONG)).collect()}
    assert found == {(0, 1.0), (1, 1.0)}


def test_literals_are_compared_whole(spark):
    one = "he took 1,000 grains and 2,000 beans then mixed 2.5 cups of milk with 3.5 cups of clean water for us"
    other = one.replace("1,000", "4,000").replace("2,000", "3,500").replace("2.5", "1.2").replace("3.5", "4.7")
    twice = one.replace("2,000", "1,000")
    d = docs(spark, [other, twice.replace("1,000", "1,500", 1)])  # the second: one literal, two values
    assert {(r["doc_id"], r["item_id"], r["share"]) for r in q.contamination(d, items(spark, one)).collect() if r["doc_id"] == 0} == {(0, 1, 1.0)}
    assert q.contamination(d.filter("doc_id = 1"), items(spark, twice)).count() == 0


def test_tokens_of_a_template(spark):
    t = "It cost US$5, (-3.25) or \u20ac7; 1,000-2,000 men of Nairobi, Kenya saw John's 5kg v1.2. Then .5 and end. 7"
    row = spark.createDataFrame([(t,)], "t string").select(q._plain("t").alias("p")).select("p", q._template(q.F.col("p")).alias("c")).first()
    assert row["p"].replace("\x01", "^") == "it cost us 5 -3.25 or \u20ac7 1,000 2,000 men of ^nairobi ^kenya saw ^john s 5kg v1.2 then .5 and end 7"
    assert row["c"].translate({1: "^", 2: "#"}) == "it cost us # # or # # # men of ^ ^ saw ^ s # v1.2 then # and end #"


def test_both_joins_agree(spark):
    d, i = docs(spark, [ITEM, ITEM + " more", "none of it"]), items(spark, ITEM, ITEM)
    one = sorted(map(tuple, q.contamination(d, i).collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert one == sorted(map(tuple, q.contamination(d, i).collect())) and len(one) == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_placeholders_alone_identify_nothing(spark):
    d = docs(spark, ["totals 71 82 93 14 25 36 47 58 69 10", "page 3 , 17 , 90 , 41", "the 5 km and 7 kg"])
    assert q.contamination(d, items(spark, "3 9 4 1 5 2 6 7 8 10", "1, 2, 3, 4", "12 km and 3 kg")).count() == 0


def test_names_stay_apart(spark):
    one = "then John gave the red box to Mary while his old friend slept near the fire"
    d = docs(spark, [one.replace("John", "Paul").replace("Mary", "Anna"), one.replace("John", "Paul").replace("Mary", "Paul")])
    assert [(r["doc_id"], r["share"]) for r in q.contamination(d, items(spark, one)).collect()] == [(0, 1.0)]


def test_any_length(spark):
    """Blanks and names of any length; long runs of marks need no stack."""
    far = ITEM.replace(" ", " " * 40)
    name = "A" + "b" * 300
    d = docs(spark, [far, ITEM.replace("John", name), "." * 400000 + " x", "A-" * 200000, "Bo " * 200000, "1." * 300000, "'" * 300000 + ITEM, "$-+" * 100000])
    assert sorted((r["doc_id"], r["share"]) for r in q.contamination(d, items(spark, ITEM)).collect()) == [(0, 1.0), (1, 1.0), (6, 1.0)]


def template(text):
    """Lower-case words, plain numbers and single names, in plain Python."""
    out, values = [], []
    raw = text.split()
    for i, t in enumerate(raw):
        name = t[0].isupper() and len(t) > 1 and i > 0 and not raw[i - 1].endswith(".")
        kind = "N" if name else "#" if t[0].isdigit() else "u" if out and out[-1] == "#" and t.rstrip(".") in q.UNITS.split() else t.lower().rstrip(".")
        out.append(kind)
        values.append(t.lower().rstrip("."))
    return out, values


def brute(text, item):
    (d, dv), (t, tv) = template(text), template(item)
    size = min(len(t), q.W)
    if size < q.SHORTEST:
        return 0
    use = [a for a in range(len(t) - size + 1) if sum(x not in ("N", "#", "u") for x in t[a:a + size]) >= q.LITERAL]
    need, have = {tuple(t[a:a + size]) for a in use}, set()
    diags = {}
    for p in range(len(d) - size + 1):
        for a in use:
            if d[p:p + size] == t[a:a + size]:
                diags.setdefault(p - a, []).append(a)
    for diag, ats in diags.items():
        pairs = {(tv[j], dv[j + diag], t[j]) for a in ats for j in range(a, a + size) if t[j] in ("N", "#", "u")}
        forward = len({v for v, _, _ in pairs}) == len({(v, g) for v, g, _ in pairs})
        own = {(v, g) for v, g, k in pairs if k != "#"}
        if forward and len({g for _, g in own}) == len(own):
            have |= {tuple(t[a:a + size]) for a in ats}
    return len(have) / len(need) if need else 0


def test_brute_force(spark):
    r = random.Random(6)
    word = lambda: r.choice(["the", "red", "box", "of", "gave", "and"])
    name = lambda: r.choice(["Ann", "Bob", "Cyd"])

    def sentence(n):
        out = []
        while len(out) < n:
            x = r.random()
            if x < 0.15 and (not out or not out[-1][0].isupper()):
                out.append(name())
            elif x < 0.3:
                out.append(str(r.randrange(20)))
            elif x < 0.35 and out and out[-1].isdigit():
                out.append(r.choice(["km", "kg"]))
            else:
                out.append(word())
        return out

    its = [sentence(r.randrange(3, 16)) for _ in range(12)]
    swap = lambda t, m: [m.get(x, x) for x in t]
    texts = []
    for _ in range(120):
        t = r.choice(its)
        m = {n: name() for n in ("Ann", "Bob", "Cyd")} | {str(k): str(r.randrange(20)) for k in range(20)} | {"km": "kg", "kg": "km"}
        body = swap(t, m) if r.random() < 0.7 else [swap([x], m)[0] if r.random() < 0.3 else x for x in t]
        texts.append(" ".join(["so"] + sentence(r.randrange(5)) + ["then"] + body + ["end"] + sentence(r.randrange(5))))
    its = ["so " + " ".join(t) for t in its]
    got = {(x["doc_id"], x["item_id"]): x["share"] for x in q.contamination(docs(spark, texts), items(spark, *its), min_share=0.0).collect()}
    want = {(i, j): s for i, t in enumerate(texts) for j, it in enumerate(its, 1) if (s := brute(t, it))}
    assert {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()} and len(want) > 60


def test_empty_tables_and_ids(spark):
    d = docs(spark, [ITEM])
    assert q.remove_contaminated(empty(spark), items(spark, ITEM)).count() == 0
    assert q.remove_contaminated(d, items(spark, ITEM).limit(0)).count() == 1
    nameless = spark.createDataFrame([(None, ITEM), (1, ITEM), (1, ITEM)], "doc_id long, text string")
    assert [r["doc_id"] for r in q.remove_contaminated(nameless, items(spark, ITEM)).collect()] == []


def test_query_finds_planted_items(spark):
    sf = "/root/testdata/sf0.001"
    bench = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {r["doc_id"] for r in rows if any(b in r["text"] for b in bench)}
    got = q.op5_template_decontamination(spark, sf).collect()
    assert {r["doc_id"] for r in got if r["contaminated"]} == want and len(got) == len(rows)


def test_no_python_on_the_main_path(spark):
    d = docs(spark, [ITEM])
    plan = q.contamination(d, items(spark, ITEM))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
