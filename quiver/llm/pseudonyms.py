"""Operator 9: personal data replaced by format-preserving Feistel pseudonyms,
with DataFrame functions only.

Emails, phone numbers, IPv4 addresses, payment cards, IBANs, US social
security numbers and dates are found by one pattern; addresses, cards, IBANs,
security numbers and dates are validated (octets, Luhn, mod 97, number ranges,
calendar), emails and phones by the pattern alone.  Each valid value becomes
another valid value of its format by a keyed permutation: an alternating Feistel
network of :data:`ROUNDS` rounds over a list of small numbers (a letter or digit
counts as two, so that even one letter is more than shifted), each half shifted
by a keyed SHA-256 stream of the other half, position by position modulo its
radix.  Where not all values of a format are valid (security numbers, days of a
century) the permutation is applied again until one is, which is a permutation
of the valid ones.  Equal values get equal pseudonyms in every document,
different ones stay different; punctuation, notation (``1.2.2020`` or
``01.02.2020``), a date's century, country codes and domains stay, check digits
are recomputed.  Texts without ``@`` or a digit skip all of it.

Edge cases: a null text stays null with no findings; an empty text is
returned as is; values that fail validation stay; a domain is read up to its
127th label, the most a name can have; repeated rows get equal results; an
empty table gives an empty result; every other column is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read_docs

ROUNDS = 8
#: Times a permutation is applied again where its result is no valid value; a
#: ninth of the numbers is invalid, so 40 leave one in 10^38 unfinished.
WALK = 40
#: The key of the registered query and pipeline, whose results can be checked
#: because it is public.  Real data need a secret one.
PUBLIC_KEY = "public key of the registered query"

_EDGE, _END = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
#: Fixed formats, in the order they are tried.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,125}\.[A-Za-z]{2,}"
IBAN = _EDGE + r"[A-Z]{2}\d{2}[A-Z0-9]{11,30}" + _END
PHONE = (r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
         r"|(?<![\w.-])(?:\(\d{3}\) ?|\d{3}[-.])\d{3}[-.]\d{4}(?![\d-])")
IP = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
ISO_DATE = r"(?<![\w-])\d{4}-\d{2}-\d{2}(?![\w-])"
DATE = r"(?<![\w./])\d{1,2}([./])\d{1,2}\1\d{4}(?!\w)"
CARD = _EDGE + r"(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})" + _END
ANY = "|".join((EMAIL, IBAN, PHONE, IP, SSN, ISO_DATE, DATE, CARD))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def feistel(values: Column, radix: Column, key: str) -> Column:
    """Keyed permutation of an array of numbers, each below its radix."""
    def shift(half: Column, of: Column, other: Column, i: Column, tag: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), i.cast("string"), tag, F.array_join(other, ",")), 256)
        stream = lambda d, j: F.conv(F.substring(d, (j % 16) * 4 + 1, F.lit(4)), 16, 10).cast("int")
        return _let(digest, lambda d: F.transform(half, lambda x, j: F.pmod(x + stream(d, j), F.get(of, j))))

    def run(s: Column) -> Column:
        def turn(t: Column, i: Column) -> Column:
            even = i % 2 == 0
            return F.struct(F.when(even, shift(t["l"], s["rl"], t["r"], i, s["tag"])).otherwise(t["l"]).alias("l"),
                            F.when(even, t["r"]).otherwise(shift(t["r"], s["rr"], t["l"], i, s["tag"])).alias("r"))
        return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), F.struct(s["l"].alias("l"), s["r"].alias("r")), turn,
                           lambda t: F.concat(t["l"], t["r"]))

    def halves(s: Column) -> Column:
        cut = F.floor(F.size(s["v"]) / 2).cast("int")
        rest = F.size(s["v"]) - cut
        return _let(F.struct(F.slice(s["v"], F.lit(1), cut).alias("l"), F.slice(s["v"], cut + 1, rest).alias("r"), F.slice(s["m"], F.lit(1), cut).alias("rl"),
                             F.slice(s["m"], cut + 1, rest).alias("rr"), F.array_join(s["m"], ",").alias("tag")), run)

    # bound once: an expression named in a lambda's body is computed for each element
    return _let(F.struct(values.alias("v"), radix.alias("m")), halves)


def _walk(first: Column, again, valid) -> Column:
    """``again`` applied until the result is valid."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first, lambda x, _: F.when(valid(x), x).otherwise(again(x)))


def _chars(s: Column) -> Column:
    return F.split(s, "")


def permute_chars(s: Column, key: str) -> Column:
    """Digits among digits, letters among letters of their case, the rest kept."""
    chars = _chars(s)
    half = lambda c: F.when(c.rlike("^[0-9]$"), 5).when(c.rlike("^[A-Za-z]$"), 13).otherwise(1)
    first = lambda c: F.when(c.rlike("^[0-9]$"), 48).when(c.rlike("^[a-z]$"), 97).when(c.rlike("^[A-Z]$"), 65).otherwise(F.ascii(c))
    pair = lambda v, h: F.array(F.floor(v / h).cast("int"), v % h)
    # a symbol is two numbers, below 2 and below half its alphabet
    values = F.flatten(F.transform(chars, lambda c: pair(F.ascii(c) - first(c), half(c))))
    radix = F.flatten(F.transform(chars, lambda c: F.array(F.when(half(c) > 1, 2).otherwise(1), half(c))))
    spell = lambda out: F.array_join(F.transform(chars, lambda c, j: F.when(
        half(c) > 1, F.char(first(c) + F.get(out, 2 * j) * half(c) + F.get(out, 2 * j + 1))).otherwise(c)), "")
    return _let(feistel(values, radix, key), spell)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``."""
    at = lambda j: F.length(_digits(F.substring(shape, F.lit(1), j + 1)))
    return F.array_join(F.transform(_chars(shape), lambda c, j: F.when(c.rlike(r"^\d$"), F.substring(digits, at(j), F.lit(1))).otherwise(c)), "")


def _luhn(digits: Column, first: int) -> Column:
    """Luhn sum; ``first`` is 1 if the last digit counts double."""
    double = lambda c, j: c.cast("int") * (1 + (j + first) % 2)
    return F.aggregate(F.transform(F.reverse(_chars(digits)), lambda c, j: F.floor(double(c, j) / 10).cast("int") + double(c, j) % 10),
                       F.lit(0), lambda a, x: a + x)


def _card(m: Column, key: str) -> Column:
    def valid(d: Column) -> Column:
        payload = permute_chars(F.substring(d, F.lit(1), F.length(d) - 1), key + ":card")
        whole = _let(payload, lambda p: F.concat(p, ((10 - _luhn(p, 1) % 10) % 10).cast("string")))
        return F.when(_luhn(d, 0) % 10 == 0, _refill(m, whole)).otherwise(m)
    return _let(_digits(m), valid)


def _mod97(s: Column) -> Column:
    step = lambda a, c: F.when(c.rlike(r"^\d$"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(_chars(s), F.lit(0), step)


def _iban(m: Column, key: str) -> Column:
    bban, country = F.substring(m, F.lit(5), F.length(m) - 4), F.substring(m, 1, 2)
    new = _let(permute_chars(bban, key + ":iban"),
               lambda b: F.concat(country, F.lpad((98 - _mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), b))
    return F.when(_mod97(F.concat(bban, F.substring(m, 1, 4))) == 1, new).otherwise(m)


def _phone(m: Column, key: str) -> Column:
    lead = F.regexp_extract(m, r"^(?:\+\d{1,3})?", 0)
    rest = F.substring(m, F.length(lead) + 1, F.length(m))
    return F.concat(lead, _refill(rest, permute_chars(_digits(rest), key + ":phone")))


def _ip(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    radix = F.array(*[F.lit(256)] * 4)
    return F.when(F.forall(octets, lambda x: x < 256), F.array_join(feistel(octets, radix, key + ":ip"), ".")).otherwise(m)


def _valid_ssn(m: Column) -> Column:
    return ~(m.rlike(r"^(?:000|666|9)") | m.rlike(r"-00-|-0000$"))


def _ssn(m: Column, key: str) -> Column:
    again = lambda x: _refill(m, permute_chars(_digits(x), key + ":ssn"))
    return F.when(_valid_ssn(m), _walk(again(m), again, _valid_ssn)).otherwise(m)


_HIGH, _LOW = 192, 191  # their product is the least of this kind above the days of a century


def _date(iso: Column, m: Column, pattern: Column, key: str) -> Column:
    """Another day of the same century, in the same notation."""
    def moved(d: Column) -> Column:
        first = F.make_date(F.floor(F.year(d) / 100).cast("int") * 100, F.lit(1), F.lit(1))
        days = F.datediff(F.make_date(F.floor(F.year(d) / 100).cast("int") * 100 + 100, F.lit(1), F.lit(1)), first)
        again = lambda x: _let(feistel(F.array(F.floor(x / _LOW).cast("int"), x % _LOW), F.array(F.lit(_HIGH), F.lit(_LOW)), key + ":date"),
                               lambda p: F.get(p, 0) * _LOW + F.get(p, 1))
        return F.when(d.isNotNull(), F.call_function(
            "date_format", F.date_add(first, _walk(again(F.datediff(d, first)), again, lambda x: x < days)), pattern)).otherwise(m)
    return _let(iso.try_cast("date"), moved)


def _day_first(m: Column, month_first: bool) -> Column:
    """ISO form of a date written d.m.y, or m/d/y."""
    part = lambda i: F.lpad(F.get(F.split(m, "[./]"), i), 2, "0")
    month, day = (part(0), part(1)) if month_first else (part(1), part(0))
    return F.concat_ws("-", F.get(F.split(m, "[./]"), 2), month, day)


def pseudonym(m: Column, key: str) -> Column:
    """The replacement of one match of :data:`ANY`."""
    def whole(pattern: str) -> Column:
        return m.rlike(f"^(?:{pattern})$")
    local = F.substring_index(m, "@", 1)
    padded = F.length(m) == 10
    return (F.when(m.contains("@"), F.concat(permute_chars(local, key + ":email"), F.substring(m, F.length(local) + 1, F.length(m))))
            .when(whole(IBAN), _iban(m, key)).when(whole(IP), _ip(m, key)).when(whole(SSN), _ssn(m, key))
            .when(whole(ISO_DATE), _date(m, m, F.lit("yyyy-MM-dd"), key))
            .when(whole(DATE) & m.contains("."), _date(_day_first(m, False), m, F.when(padded, "dd.MM.yyyy").otherwise("d.M.yyyy"), key))
            .when(whole(DATE), _date(_day_first(m, True), m, F.when(padded, "MM/dd/yyyy").otherwise("M/d/yyyy"), key))
            .when(whole(CARD), _card(m, key)).otherwise(_phone(m, key)))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", length: str | None = None, counts: bool = True) -> DataFrame:
    """``docs`` with pseudonyms in ``text``; where the text changed, the column
    ``length`` (if named) gets its new length.  ``counts`` adds pii_found and
    pii_replaced, in place of columns of these names."""
    t = F.col(text)
    own = "_"
    while any(c.lower().startswith(own) for c in docs.columns):  # names that no column has
        own += "_"
    hit, new, old = own + "hits", own + "new", own + "old"
    hits = F.when(t.rlike("[0-9@]"), F.regexp_extract_all(t, F.lit(ANY), F.lit(0)))
    some = F.col(hit).isNotNull() & (F.size(hit) > 0)
    woven = F.array_join(F.flatten(F.zip_with(F.split(t, ANY, -1), F.col(new), lambda g, r: F.array(g, F.coalesce(r, F.lit(""))))), "")
    changed = F.size(F.filter(F.arrays_zip(F.col(hit).alias("a"), F.col(new).alias("b")), lambda x: x["a"] != x["b"]))
    out = (docs.withColumn(hit, hits).withColumn(new, F.when(some, F.transform(hit, lambda m: pseudonym(m, key))))
           .withColumn(old, F.when(some, changed).otherwise(0).cast("long")).withColumn(text, F.when(some, woven).otherwise(t)))
    if length:
        out = out.withColumn(length, F.when(F.col(old) > 0, F.length(text).cast(docs.schema[length].dataType)).otherwise(F.col(length)))
    if counts:
        out = out.withColumn("pii_found", F.when(some, F.size(hit)).otherwise(0).cast("long")).withColumn("pii_replaced", F.col(old))
    return out.drop(hit, new, old)


def op9_pseudonyms(spark, sf_dir: str) -> DataFrame:
    return pseudonymise(read_docs(spark, sf_dir, "doc_id", "text"), PUBLIC_KEY).select("doc_id", "pii_found", "pii_replaced", "text")
