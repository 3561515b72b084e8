"""Operator 5: benchmark decontamination by template canonicalisation, with
DataFrame functions only.

Both sides are brought to a template form, token for token: numbers (whole
literals with sign, currency, thousands groups and decimals) become one
placeholder, units another, names (runs of capitalised words inside a sentence)
a third; other tokens are lower-cased and lose their marks.  Windows of ``W``
template tokens are hashed and joined.  Hits of one document with one item on
one diagonal (position in the text less position in the item) belong to one
occurrence; their slots are consistent if every value of the item (a number,
name or unit) stands for one value of the document only, and no two names or
units of the item for one of the document (two numbers may become equal).  A
window identifies an item only by its words: windows of an item with fewer than
``LITERAL`` tokens that are no placeholders are not used.  A document is
contaminated if consistent hits cover at least ``min_share`` of an item's
distinct windows, so a question with other numbers and names is caught, and
one that mixes them up is not.

The items' windows are written first, so the planner knows their size and
sends them to all tasks or shuffles both sides by the hash; only hits go on.

Edge cases: null and empty texts have no windows and are clean; items shorter
than ``W`` tokens are one window of their own length if they have at least
``SHORTEST`` tokens; items without a usable window are too short to identify and
never matched; rows of one doc_id share a verdict, and rows without one are
named by their text in :func:`remove_contaminated` (the query leaves them out of
its verdicts); repeated items each report; empty tables leave everything clean;
extra columns are kept by :func:`remove_contaminated`; white space and names may
be of any length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, read_docs

W, SHORTEST, LITERAL = 8, 4, 3
NAME, NUMBER, UNIT = "\x01", "\x02", "\x03"
JOIN = "\x04"  # between the words of one name
#: Fixed list of unit words.
UNITS = ("mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres "
         "kilometer kilometers kilometre kilometres mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes "
         "ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks "
         "month months year years cent cents dollar dollars euro euros usd eur percent degree degrees kph mph w kw v")

_BLANK = r"\x20\x09-\x0D"


#: Marks that belong to a number: between digits, a sign, a currency, a leading point.
_OF_NUMBER = (r"(?<=\d)[.,](?=\d)|(?<![^\x20\x09-\x0D(\p{Sc}])[-+](?=\p{Sc}?\.?\d)"
              r"|(?<![^\p{Punct}\x20\x09-\x0D])\$(?=[-+]?\.?\d)|(?<![^\x20\x09-\x0D(+\p{Sc}-])\.(?=\d)")


#: What goes on within a name: letters, and marks no capital follows.
_IN_NAME = r"(?:[\p{L}\p{M}\p{N}]|['’-](?!\p{Lu}))++"


def _plain(text: Column) -> Column:
    """Lower-cased tokens, one space between; marks separate tokens, but not
    within a numeric literal.  A name's token starts with NAME: a capital letter
    after white space that no sentence end precedes; a run of names with only
    white space between is one token.  Loops over more than single characters
    are possessive: they neither recurse nor go back."""
    named = F.regexp_replace(F.coalesce(text, F.lit("")), rf"([^.!?{_BLANK}][{_BLANK}]++)(?=\p{{Lu}}(?:\p{{Ll}}|['’]\p{{Lu}}))", f"$1{NAME}")
    named = F.regexp_replace(named, rf"({NAME}{_IN_NAME}|(?!\A)\G{_IN_NAME})['’-](?=\p{{Lu}})", f"$1{JOIN}")
    named = F.regexp_replace(named, rf"({NAME}[\p{{L}}\p{{M}}\p{{N}}{JOIN}]++)[{_BLANK}]++(?={NAME})", f"$1{JOIN}")
    # the cheap tests come first: marks of numbers are looked for at few places
    marks = rf"(?=[{_BLANK}\p{{Punct}}])(?:[{_BLANK}\p{{Punct}}&&[^.,+$-]]|(?=[.,+$-])(?!{_OF_NUMBER}).)++"
    return F.trim(F.regexp_replace(F.lower(named), marks, " "))


def _template(plain: Column) -> Column:
    """One placeholder for each token that is a name, number or unit."""
    out = F.regexp_replace(plain, rf"{NAME}\S*", NAME)
    out = F.regexp_replace(out, r"(?<!\S)[-+.\p{Sc}]{0,3}\d\S*", NUMBER)
    return F.regexp_replace(out, rf"(?<=[{NUMBER}] )(?:{UNITS.replace(' ', '|')})(?!\S)", UNIT)


def _tokens(s: Column) -> Column:
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, " "))


def _windows(tokens: Column, size: int) -> Column:
    at = F.when(F.size(tokens) >= size, F.sequence(F.lit(0), F.size(tokens) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.array_join(F.slice(tokens, i + 1, F.lit(size)), " ")))


def item_windows(items: DataFrame) -> DataFrame:
    """item_id, at, size, hash and the number of distinct windows."""
    tok = items.select("item_id", _template(_plain(F.col("text"))).alias("s")).select("item_id", _tokens(F.col("s")).alias("t"))

    def usable(own: DataFrame, size: int) -> DataFrame:
        w = own.select("item_id", "t", F.lit(size).alias("size"), F.posexplode(_windows(F.col("t"), size)).alias("at", "hash"))
        words = F.filter(F.slice("t", F.col("at") + 1, F.lit(size)), lambda x: ~x.isin(NAME, NUMBER, UNIT))
        return w.filter(F.size(words) >= LITERAL).select("item_id", "size", "at", "hash")

    parts = [usable(tok.filter(F.size("t") >= W), W), *(usable(tok.filter(F.size("t") == size), size) for size in range(SHORTEST, W))]
    return reduce(DataFrame.unionByName, parts)


def hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, pos, item_id, at, size): windows found in documents."""
    sizes = [r["size"] for r in windows.select("size").distinct().collect()]  # at most W - SHORTEST + 1
    base = docs.filter("doc_id is not null").select("doc_id", _template(_plain(F.col("text"))).alias("s")).select("doc_id", _tokens(F.col("s")).alias("t"))
    found = [base.select("doc_id", F.posexplode(_windows(F.col("t"), size)).alias("pos", "hash"))
             .join(windows.filter(F.col("size") == size), "hash").select("doc_id", "pos", "item_id", "at", "size") for size in sizes]
    empty = docs.sparkSession.createDataFrame([], "doc_id long, pos int, item_id long, at int, size int")
    return reduce(DataFrame.unionByName, found) if found else empty


def contamination(docs: DataFrame, items: DataFrame, min_share: float = 0.5) -> DataFrame:
    """doc_id, item_id, share: items found in documents with consistent slots,
    whatever their share."""
    windows = materialize(item_windows(items.filter("item_id is not null")))
    found = materialize(hits(docs, windows).distinct())
    need = windows.groupBy("item_id").agg(F.countDistinct("hash").alias("need"))

    # slots: the positions an item's hits cover, with the values of both sides
    slot = (items.select("item_id", _plain(F.col("text")).alias("p")).withColumn("c", _template(F.col("p")))
            .select("item_id", F.posexplode(F.arrays_zip(_tokens(F.col("c")).alias("c"), _tokens(F.col("p")).alias("v"))).alias("j", "x"))
            .filter(F.col("x.c").isin(NAME, NUMBER, UNIT)).select("item_id", "j", F.col("x.v").alias("value"), (F.col("x.c") != NUMBER).alias("own")))
    covered = (found.withColumn("diag", F.col("pos") - F.col("at"))
               .select("doc_id", "item_id", "diag", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("size") - 1)).alias("j"))
               .join(slot, ["item_id", "j"]).distinct())
    words = (docs.join(covered.select("doc_id").distinct(), "doc_id", "left_semi")
             .select("doc_id", _tokens(_plain(F.col("text"))).alias("v")))
    seen = covered.join(words, "doc_id").select("doc_id", "item_id", "diag", "value", "own", F.get("v", F.col("j") + F.col("diag")).alias("got"))

    def differ(rows: DataFrame, one: str, other: str) -> DataFrame:
        return (rows.groupBy("doc_id", "item_id", "diag", one).agg(F.min(other).alias("a"), F.max(other).alias("b"))
                .filter("a <> b").select("doc_id", "item_id", "diag"))

    mixed = differ(seen, "value", "got").unionByName(differ(seen.filter("own"), "got", "value")).distinct()
    good = found.withColumn("diag", F.col("pos") - F.col("at")).join(mixed, ["doc_id", "item_id", "diag"], "left_anti")
    distinct = good.join(windows, ["item_id", "at", "size"]).groupBy("doc_id", "item_id").agg(F.countDistinct("hash").alias("have"))
    return (distinct.join(need, "item_id").withColumn("share", F.col("have") / F.col("need"))
            .filter(F.col("share") >= min_share).select("doc_id", "item_id", "share"))


def remove_contaminated(docs: DataFrame, items: DataFrame, min_share: float = 0.5) -> DataFrame:
    bad = materialize(contamination(docs, items, min_share).select("doc_id").distinct())
    kept = docs.join(bad, "doc_id", "left_anti").select(*docs.columns)
    nameless = docs.filter("doc_id is null")
    if not nameless.limit(1).count():
        return kept
    by_text = F.xxhash64(F.sha2("text", 256))
    found = contamination(nameless.select(by_text.alias("doc_id"), "text"), items, min_share).select(F.col("doc_id").alias("_by")).distinct()
    found = materialize(found)
    return (kept.filter("doc_id is not null").unionByName(nameless.join(found, by_text == F.col("_by"), "left_anti").select(*docs.columns)))


def op5_template_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = read_docs(spark, sf_dir, "doc_id", "text")
    found = contamination(docs, read_docs(spark, sf_dir, "item_id", "text", table="benchmark"))
    worst = (found.groupBy("doc_id").agg(F.max("share").alias("share"), F.sort_array(F.collect_set("item_id")).alias("items")))
    return (docs.select("doc_id").join(worst, "doc_id", "left")
            .select("doc_id", F.col("share").isNotNull().alias("contaminated"), F.round(F.coalesce("share", F.lit(0.0)), 6).alias("share"),
                    F.coalesce("items", F.array().cast("array<long>")).alias("items")))
