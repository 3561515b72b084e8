import hashlib
import random
import re
from datetime import date

from pyspark.sql import functions as F

from quiver.llm import pseudonyms as q
from helpers import ODD, by_id, docs, empty


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def mod97(s):
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def one(spark, *texts):
    got = by_id(q.pseudonymise(docs(spark, texts), "k"), "text")
    return [got[i][0] for i in range(len(texts))]


def test_formats_and_links(spark):
    a, b = one(spark, "ab.12@mail6.example.com, +1 (319) 555-5132 4799134681044206; 55.63.178.142.",
               "4799-1346-8104-4206 ab.12@mail6.example.com 55.63.178.142 +1 319 555 5132")
    m = re.fullmatch(r"([a-z]{2}\.\d{2})@mail6\.example\.com, \+1 \((\d{3})\) (\d{3})-(\d{4}) (\d{16}); (\d+\.\d+\.\d+\.\d+)\.", a)
    assert m and luhn(m[5]) and m[5] != "4799134681044206" and all(int(x) < 256 for x in m[6].split("."))
    card = "-".join(m[5][i:i + 4] for i in range(0, 16, 4))
    assert b == f"{card} {m[1]}@mail6.example.com {m[6]} +1 {m[2]} {m[3]} {m[4]}"


def test_checked_values_stay_valid(spark):
    a, = one(spark, "GB82WEST12345698765432 123-45-6789 2024-02-29 1.2.2020 12/31/1999")
    iban, ssn, iso, dmy, mdy = a.split(" ")
    assert mod97(iban) == 1 and iban[:2] == "GB" and re.fullmatch(r"\d{3}-\d{2}-\d{4}", ssn)
    date.fromisoformat(iso)
    d, m, y = dmy.split(".")
    date(int(y), int(m), int(d))
    m, d, y = mdy.split("/")
    date(int(y), int(m), int(d))


def test_invalid_values_and_clean_texts_stay(spark):
    texts = [*ODD, "999.1.1.1 4799134681044207 2024-02-30 000-12-3456 GB82WEST12345698765433", "version 2.0 of 12 items @ home"]
    got = by_id(q.pseudonymise(docs(spark, texts), "k"), "text", "pii_replaced")
    assert got == {i: (t, 0) for i, t in enumerate(texts)}


def test_permutation(spark):
    """All 4-digit strings get different pseudonyms, and another key others."""
    v = spark.range(10000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("v"))
    r = v.select("v", q.permute_chars(F.col("v"), "k").alias("p"), q.permute_chars(F.col("v"), "l").alias("o")).collect()
    assert len({x["p"] for x in r}) == 10000 and {x["p"] for x in r} == {x["v"] for x in r}
    assert sum(x["p"] == x["o"] for x in r) < 20


def symbol(c):
    for base, size in ((48, 10), (97, 26), (65, 26)):
        if base <= ord(c) < base + size:
            return base, size // 2
    return ord(c), 1


def feistel(values, radix, key):
    """The network once more, in plain Python."""
    cut = len(values) // 2
    half, of = [values[:cut], values[cut:]], [radix[:cut], radix[cut:]]
    for i in range(q.ROUNDS):
        e = i % 2
        d = hashlib.sha256("|".join((key, str(i), ",".join(map(str, radix)), ",".join(map(str, half[1 - e])))).encode()).hexdigest()
        half[e] = [(x + int(d[j % 16 * 4:j % 16 * 4 + 4], 16)) % of[e][j] for j, x in enumerate(half[e])]
    return half[0] + half[1]


def permuted(s, key):
    sym = [symbol(c) for c in s]
    values = [x for c, (b, h) in zip(s, sym) for x in divmod(ord(c) - b, h)]
    out = feistel(values, [x for _, h in sym for x in (2 if h > 1 else 1, h)], key)
    return "".join(chr(b + out[2 * j] * h + out[2 * j + 1]) if h > 1 else c for j, (c, (b, h)) in enumerate(zip(s, sym)))


def ssn_ok(s):
    a, b, c = s.split("-")
    return a not in ("000", "666") and a[0] != "9" and b != "00" and c != "0000"


def test_brute_force(spark):
    """Numbers, names and dates are those of a plain Python version."""
    r = random.Random(3)
    ssn = [s for s in (f"{r.randrange(900):03d}-{r.randrange(100):02d}-{r.randrange(10000):04d}" for _ in range(300)) if ssn_ok(s)]
    days = [date.fromordinal(r.randrange(1, date(2200, 1, 1).toordinal())) for _ in range(300)] + [date(1900, 1, 1), date(1999, 12, 31), date(2000, 2, 29)]
    names = ["a", "b", "Z", "0", "a.b", "x_1", "john.doe+tag"]
    texts = [*ssn, *[d.isoformat() for d in days], *[f"{n}@mail.org" for n in names]]

    def want(t):
        if "@" in t:
            return permuted(t[:-9], "k:email") + t[-9:]
        if t in ssn:
            p = t
            while True:
                p = permuted(p.replace("-", ""), "k:ssn")
                p = f"{p[:3]}-{p[3:5]}-{p[5:]}"
                if ssn_ok(p):
                    return p
        d = date.fromisoformat(t)
        first = date(d.year // 100 * 100, 1, 1) if d.year >= 100 else None
        start = first.toordinal() if first else date(1, 1, 1).toordinal() - 366
        n = date(d.year // 100 * 100 + 100, 1, 1).toordinal() - start
        x = d.toordinal() - start
        while True:
            a, b = feistel(list(divmod(x, 191)), [192, 191], "k:date")
            x = a * 191 + b
            if x < n:
                return (date.fromordinal(start + x) if start + x >= 1 else None)

    got = one(spark, *texts)
    for t, g in zip(texts, got, strict=True):
        w = want(t)
        assert w is None and g.startswith("0000-") or g == (w.isoformat() if isinstance(w, date) else w), (t, g, w)
    assert len({g for t, g in zip(texts, got) if t in ssn}) == len(set(ssn))


def test_security_numbers_stay_valid_and_distinct(spark):
    v = spark.range(20000).select(F.format_string("%03d-%02d-%04d", 1 + F.col("id") % 899, 1 + F.col("id") % 99, 1 + F.col("id") % 9999).alias("v"))
    r = [x["p"] for x in v.distinct().filter(q._valid_ssn(F.col("v"))).select(q._ssn(F.col("v"), "k").alias("p")).collect()]
    assert len(r) > 10000 and all(map(ssn_ok, r)) and len(set(r)) == len(r)


def test_notation_and_century_stay(spark):
    a, b, c, d = one(spark, "1.2.2020", "01.02.2020", "1/2/1985", "2020-02-01")
    p = [int(x) for x in a.split(".")]
    assert a == f"{p[0]}.{p[1]}.{p[2]}" and b == f"{p[0]:02d}.{p[1]:02d}.{p[2]}" and d == f"{p[2]}-{p[1]:02d}-{p[0]:02d}"
    assert p[2] // 100 == 20 and c.split("/")[2][:2] == "19" and c == "/".join(str(int(x)) for x in c.split("/"))


def test_very_long_values(spark):
    long = ["a@b" + ".a" * 500000 + ".com", "x" * 300000 + "@b.com", "a@" + "b" * 1000000, "1" * 500000, "a@" * 200000, "1.2." * 200000, "A" * 500000 + "@",
            "a@b" + ".cd" * 300000]
    got = one(spark, *long)
    assert all(len(g) == len(t) for g, t in zip(got, long)) and got[0] == long[0] and got[1] != long[1] and got[1].endswith("@b.com")
    assert got[7][1:] == long[7][1:]


def test_columns_length_and_plan(spark):
    d = docs(spark, ["1.2.3.4 and 200.100.50.25", None])
    out = q.pseudonymise(d, "k", length="n_chars", counts=False)
    assert out.columns == d.columns
    r = out.filter("doc_id = 0").collect()[0]
    assert r["n_chars"] == len(r["text"]) and r["_hits"] == "h" and r["name"] == "n"
    assert "Python" not in out._jdf.queryExecution().toString()
    assert q.pseudonymise(empty(spark), "k").count() == 0
