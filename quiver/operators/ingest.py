"""Ingest jobs: split documents into chunks, embed them, extract triples.

Chunking and link extraction work inside each document row with higher-order
functions, so they need no shuffle: a document is one row and all of its text
is processed (no prefixes).  Embedding models and triple extractors plug in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_
from typing import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentence end marks, paragraph ends, and the chunk size in words.
SENTENCE_END = r"([.!?])\s+"
PARAGRAPH_END = r"\n\s*\n"
CHUNK_SIZE = 512
TRIPLETS_PER_CHUNK = 2
_SEP = "\u0001"  # separates sentences; one in a text counts as white space


def sentences(text: Column) -> Column:
    """Sentences in order (a sentence ends at . ! or ? followed by whitespace)."""
    return F.split(F.regexp_replace(F.replace(text, F.lit(_SEP), F.lit(" ")), SENTENCE_END, "$1" + _SEP), _SEP)


def words(s: Column) -> Column:
    return F.filter(F.split(s, r"\s+"), lambda w: w != F.lit(""))


def chunk_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    size: int = CHUNK_SIZE) -> DataFrame:
    """Greedy packing of whole sentences into chunks of at most ``size`` words.

    A sentence longer than ``size`` is cut into ``size``-word pieces first;
    otherwise sentences are never split.  Output: id, chunk_no, n_words, text
    (words joined by single spaces).
    """
    sz = F.lit(size)
    sw = F.transform(sentences(F.col(text_col)), lambda s: words(s))
    # pieces: every sentence cut into <= size-word slices; empty ones vanish
    pieces = F.flatten(F.transform(sw, lambda w: F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(w) / sz).cast("int") - 1),
        lambda p: F.slice(w, p * sz + 1, sz))))
    pieces = F.filter(pieces, lambda p: F.size(p) > 0)
    lens = F.transform(F.col("_pieces"), lambda p: F.size(p))
    # greedy pass: carry the running length and the 1-based start of each chunk
    # (the array grows once per chunk, not once per piece)
    init = F.struct(F.lit(0).alias("cur"), F.lit(0).alias("i"),
                    F.array().cast("array<int>").alias("starts"))

    def step(acc, n):
        i = acc["i"] + 1
        new = (acc["cur"] == 0) | (acc["cur"] + n > sz)
        return F.struct(F.when(new, n).otherwise(acc["cur"] + n).alias("cur"), i.alias("i"),
                        F.when(new, F.concat(acc["starts"], F.array(i))).otherwise(acc["starts"]).alias("starts"))

    packed = docs.select(id_col, pieces.alias("_pieces")).filter(F.size("_pieces") > 0)
    total = F.size(F.flatten("_pieces"))
    # a document that fits in one chunk needs no packing pass
    starts = F.when(total <= sz, F.array(F.lit(1))).otherwise(F.aggregate(lens, init, step)["starts"])
    packed = packed.select(id_col, "_pieces", starts.alias("_starts"))
    n_chunks = F.size("_starts")
    ends = F.concat(F.slice("_starts", 2, F.greatest(n_chunks - 1, F.lit(0))),
                    F.array(F.size("_pieces") + 1))
    bounds = F.arrays_zip(F.col("_starts").alias("s"), ends.alias("e"))
    chunks = F.transform(bounds, lambda b, k: F.struct(
        k.alias("chunk_no"), F.flatten(F.slice("_pieces", b["s"], b["e"] - b["s"])).alias("w")))
    return (packed.select(id_col, F.explode(chunks).alias("c"))
            .select(id_col, F.col("c.chunk_no").alias("chunk_no"), F.size("c.w").alias("n_words"),
                    F.array_join("c.w", " ").alias("text")))


def split_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = CHUNK_SIZE,
                    overlap: int = 0) -> DataFrame:
    """Chunks of at most ``size`` words along the largest units that fit, each
    starting with the end of the one before.

    A paragraph (set off by an empty line) of at most ``size`` words is one
    piece; a longer one gives its sentences, and a longer sentence slices of
    ``size`` words.  Pieces are packed greedily.  A new chunk first repeats the
    longest run of whole pieces at the end of the chunk before that has at most
    ``overlap`` words and leaves room for the next piece.  NULL texts and texts
    without words have no chunks.

    One pass over a document's pieces; what it carries is the last pieces of the
    open chunk (at most ``overlap`` of them, as each has a word).  Output: the id
    column, chunk_no, n_words, n_overlap (words repeated), text (words joined by
    single spaces).
    """
    if size < 1 or not 0 <= overlap < size:
        raise ValueError("need size >= 1 and 0 <= overlap < size")
    sz, once = F.lit(size), lambda value, body: F.element_at(F.transform(F.array(value), body), 1)

    def slices(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(w) / sz).cast("int") - 1, F.lit(0))),
                           lambda p: F.slice(w, p * sz + 1, sz))

    def paragraph(p: Column) -> Column:
        return once(words(p), lambda w: F.when(F.size(w) <= sz, F.array(w)).otherwise(
            F.flatten(F.transform(sentences(p), lambda s: once(words(s), slices)))))

    pieces = F.flatten(F.transform(F.split(F.col(text_col), PARAGRAPH_END), paragraph))
    split = docs.select(F.col(id_col).alias("_id"), F.filter(pieces, lambda w: F.size(w) > 0).alias("_pieces"))
    split = split.filter(F.size("_pieces") > 0)

    # state: words of the open chunk, pieces seen, lengths of its last pieces,
    # and per chunk (first piece, first piece that is not repeated, words repeated)
    spans = "array<struct<first:int,own:int,again:int>>"
    init = F.struct(F.lit(0).alias("cur"), F.lit(0).alias("i"), F.array().cast("array<int>").alias("tail"),
                    F.array().cast(spans).alias("spans"))

    def carried(tail: Column, n: Column) -> Column:
        """(pieces, words) to repeat: whole pieces from the back while they fit."""
        room = F.least(F.lit(overlap), sz - n)
        start = F.struct(F.lit(0).alias("m"), F.lit(0).alias("words"), F.lit(True).alias("on"))

        def back(acc, length):
            fits = acc["on"] & (acc["words"] + length <= room)
            return F.struct(F.when(fits, acc["m"] + 1).otherwise(acc["m"]).alias("m"),
                            F.when(fits, acc["words"] + length).otherwise(acc["words"]).alias("words"), fits.alias("on"))
        return F.aggregate(F.reverse(tail), start, back)

    def last(tail: Column, m: Column) -> Column:
        m = F.least(m, F.size(tail))
        return F.slice(tail, F.size(tail) - m + 1, m)

    def step(acc, n):
        i = acc["i"] + 1
        grown = F.struct((acc["cur"] + n).alias("cur"), i.alias("i"),
                         last(F.concat(acc["tail"], F.array(n)), F.lit(overlap)).alias("tail"), acc["spans"].alias("spans"))
        opened = once(carried(acc["tail"], n), lambda c: F.struct(
            (c["words"] + n).alias("cur"), i.alias("i"),
            last(F.concat(last(acc["tail"], c["m"]), F.array(n)), F.lit(overlap)).alias("tail"),
            F.concat(acc["spans"], F.array(F.struct((i - c["m"]).alias("first"), i.alias("own"), c["words"].alias("again")))).alias("spans")))
        return F.when((F.size(acc["spans"]) == 0) | (acc["cur"] + n > sz), opened).otherwise(grown)

    lens = F.transform(F.col("_pieces"), lambda w: F.size(w))
    split = split.select("_id", "_pieces", F.aggregate(lens, init, step)["spans"].alias("_spans"))
    # a chunk ends before the first piece that the next one has for itself
    ends = F.concat(F.transform(F.slice("_spans", 2, F.size("_spans")), lambda s: s["own"]), F.array(F.size("_pieces") + 1))
    chunks = F.transform(F.arrays_zip(F.col("_spans").alias("s"), ends.alias("e")), lambda b, k: F.struct(
        k.alias("chunk_no"), b["s"]["again"].alias("n_overlap"),
        F.flatten(F.slice("_pieces", b["s"]["first"], b["e"] - b["s"]["first"])).alias("w")))
    return (split.select("_id", F.explode(chunks).alias("c"))
            .select(F.col("_id").alias(id_col), F.col("c.chunk_no").alias("chunk_no"), F.size("c.w").alias("n_words"),
                    F.col("c.n_overlap").alias("n_overlap"), F.array_join("c.w", " ").alias("text")))


# ------------------------------------------------------------------ embedding

def hashed_bow(text: Column, dim: int) -> Column:
    """Signed hashed bag of words, L2-normalised: a deterministic local model
    in built-in functions.  A word's MD5 picks its place and sign; NULL for a
    text without words."""
    code = lambda w: F.conv(F.substring(F.md5(w.cast("binary")), 1, 8), 16, 10).cast("long") % (2 * dim)
    codes = F.transform(words(F.lower(text)), code)
    count = lambda c, v: F.size(c) - F.size(F.array_remove(c, v))
    raw = lambda c: F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: (
        count(c, (2 * i).cast("long")) - count(c, (2 * i + 1).cast("long"))).cast("double"))
    unit = lambda v: F.transform(F.array(F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))), lambda n: F.when(
        n > 0, F.transform(v, lambda x: x / n)))
    once = lambda value, body: F.element_at(F.transform(F.array(value), body), 1)
    return once(codes, lambda c: once(raw(c), lambda v: F.element_at(unit(v), 1)))


def embed_chunks(chunks: DataFrame, dim: int = 64, text_col: str = "text", udf=None) -> DataFrame:
    """Add/replace ``embedding``; ``udf`` plugs in another model (a function of
    the text column, for instance an Arrow-batched pandas UDF)."""
    return chunks.withColumn("embedding", udf(F.col(text_col)) if udf else hashed_bow(F.col(text_col), dim))


# ---------------------------------------------------------- triple extraction

def extract_links(pages: DataFrame, pattern: str, id_col: str = "url", html_col: str = "html",
                  predicate: str = "LINKS_TO") -> DataFrame:
    """(page)-[predicate]->(href) for every match of ``pattern`` (group 1)."""
    return (pages.select(id_col, F.explode(F.regexp_extract_all(html_col, F.lit(pattern), 1)).alias("dst"))
            .select(F.col(id_col).alias("src"), F.lit(predicate).alias("predicate"), "dst").distinct())


def cap_links_per_chunk(pages: DataFrame, pattern: str, n: int = TRIPLETS_PER_CHUNK,
                        id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """The first ``n`` distinct links of each page, in document order (the
    per-chunk triplet cap is the feature).  Done inside the row: no window."""
    links = F.slice(F.array_distinct(F.regexp_extract_all(html_col, F.lit(pattern), 1)), 1, n)
    return pages.select(id_col, F.posexplode(links).alias("pos", "dst")).select(
        id_col, (F.col("pos") + 1).alias("pos"), "dst")


Extractor = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
TRIPLE_SCHEMA = "triplet_source_id string, head string, head_label string, label string, tail string, tail_label string"


def extract_triples(chunks: DataFrame, extractor: Extractor | Callable[[DataFrame], DataFrame],
                    schema: Sequence[tuple[str, str, str]] | None = None, pandas: bool = True) -> tuple[DataFrame, DataFrame]:
    """Triples of ``chunks`` (id, text) by any extractor, and those refused.

    ``extractor`` is a ``mapInPandas`` function from batches of (id, text) to
    batches of :data:`TRIPLE_SCHEMA`, or with ``pandas=False`` a function from
    DataFrame to DataFrame.  With ``schema`` (strict mode) only triples whose
    (head_label, label, tail_label) it lists are accepted."""
    given = chunks.select("id", "text")
    found = given.mapInPandas(extractor, TRIPLE_SCHEMA) if pandas else extractor(given)
    names = [c.split()[0] for c in TRIPLE_SCHEMA.split(", ")]
    found = found.select(*names)
    whole = F.col("head").isNotNull() & F.col("label").isNotNull() & F.col("tail").isNotNull()
    if schema is not None:
        kinds = [(F.col("head_label") == h) & (F.col("label") == r) & (F.col("tail_label") == t) for h, r, t in schema]
        whole = whole & F.coalesce(reduce(or_, kinds, F.lit(False)), F.lit(False))
    return found.filter(whole), found.filter(~whole)
