"""Retrieval that combines vector search with the graph.

Everything is one plan per call: the vector hits are a k-row result, so the
joins that follow (mentions, entities, walks from the mentioned entities,
source chunk text) start from a proven-small side.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiver.model import PropertyGraph
from quiver.operators import cells, lookup, traverse, vector
from quiver.operators.keys import Keys, attach
from quiver.session import materialize


def vector_query(graph: PropertyGraph, query: Sequence[float], root: str, k: int = vector.TOP_K, state: str | None = None) -> DataFrame:
    """The k chunks most similar to the query through the index under ``root``,
    which is built or refreshed first if the chunks changed: id, similarity,
    rank.  Exact; an empty result when no chunk has a vector."""
    dim = graph.embed_dim or vector.choose_dimension(graph.chunks, len(query))
    index = cells.ensure(graph.chunks, root, dim, state)
    if index is None:
        return vector.topk(graph.chunks, query, k, dim, cols=("id",))
    return cells.search(graph.spark, index, query, k)


def entities_of_chunks(graph: PropertyGraph, hits: DataFrame) -> DataFrame:
    """Entities each hit chunk MENTIONS: chunk_id, entity_table, entity_id, name."""
    m = graph.mentions.join(hits.select(F.col("id").alias("chunk_id")), "chunk_id", "left_semi")
    ents = graph.entities.select(F.col("node_table").alias("entity_table"), F.col("id").alias("entity_id"), "name")
    return m.join(ents, ["entity_table", "entity_id"]).select("chunk_id", "entity_table", "entity_id", "name")


def with_source_text(graph: PropertyGraph, triplets: DataFrame) -> DataFrame:
    """Attach the text of each triplet's source chunk (NULL when absent)."""
    return attach(triplets, graph.chunks.select("id", "text"), ["id"], "text", {"source_text": ["triplet_source_id"]})


def _pieces(size: Column, d: int) -> Column:
    """Start and length of the d + 1 pieces of a string of ``size`` characters."""
    at = lambda k: F.floor(F.lit(k) * size / (d + 1)).cast("int")
    return F.array(*[F.struct(F.lit(k).alias("piece"), at(k).alias("at"), (at(k + 1) - at(k)).alias("n")) for k in range(d + 1)])


def name_index(graph: PropertyGraph, distance: int = 2) -> DataFrame:
    """Inverted index of names for searches up to ``distance`` edits: each
    lower-cased name under each of its ``distance`` + 1 pieces (size, piece,
    text, node_table, id, name)."""
    name = F.lower("name")
    rows = graph.entities.filter(F.col("name").isNotNull()).select("node_table", "id", name.alias("name"), F.length(name).alias("size"))
    return (rows.withColumn("p", F.explode(_pieces(F.col("size"), distance)))
            .select("size", F.col("p.piece").alias("piece"), F.substring("name", F.col("p.at") + 1, F.col("p.n")).alias("text"), "node_table", "id", "name"))


VARIANT_MAX = 48  # names up to this many characters are met by their variants: at most 1177 for 2 edits


def _variants(text: Column, size: Column, d: int, longest: int) -> Column:
    """Hashes of a string with 0 to ``d`` of its characters left out that a string of
    up to ``longest`` characters may meet: of one with as many characters or fewer, ``d`` are left
    out, of a longer one that many less."""
    cut = lambda x: F.transform(F.sequence(F.lit(1), F.length(x)), lambda k: F.concat(F.substr(x, F.lit(1), k - 1), F.substr(x, k + 1)))
    level, levels = F.array(text), []
    for left_out in range(d + 1):
        if left_out:
            level = F.array_distinct(F.flatten(F.transform(level, lambda x: F.when(F.length(x) > 0, cut(x)).otherwise(F.array(x)))))
        levels.append(level if left_out == d else F.when(size + (d - left_out) <= longest, level).otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.transform(F.concat(*levels), lambda x: F.xxhash64(x)))


def _close_names(names: DataFrame, kw: DataFrame, distance: int) -> DataFrame:
    """Distinct (keyword, name) that share a variant: all within ``distance``
    edits do, and those that do are within twice that many.  The planner does not
    know what ``explode`` makes of a row, so it is told to sort both sides: it
    would send all variants of a small file's keywords through the driver."""
    d = distance
    longest = names.agg(F.max("size")).first()[0] or 0, kw.agg(F.max("size")).first()[0] or 0
    a = names.select("name", "size", F.explode(_variants(F.col("name"), F.col("size"), d, longest[1])).alias("variant"))
    b = kw.select("keyword", F.col("size").alias("kw_size"), F.explode(_variants(F.col("keyword"), F.col("size"), d, longest[0])).alias("variant"))
    return a.join(b.hint("merge"), "variant").filter(F.abs(F.col("size") - F.col("kw_size")) <= d).select("keyword", "name").distinct()


def keyword_matches(graph: PropertyGraph, keywords: DataFrame, distance: int = 2, index: DataFrame | None = None) -> DataFrame:
    """Entities whose lower-cased name is within ``distance`` edits of a
    keyword: keyword, node_table, id, name, distance.

    Of ``distance`` + 1 pieces of a name, at least one is untouched by that many
    edits and stands in the keyword at most ``distance`` places away.  So a
    keyword's substrings of the pieces' lengths (a few dozen rows each) tell the
    names worth a look, by a semi join: a piece that all names share pairs
    nothing.  Of a name and a keyword within ``distance`` edits the same string
    is left when at most ``distance`` characters are taken from each; names and
    keywords are joined on these variants of the whole string, and only the
    candidates' distances are computed.  Names over ``VARIANT_MAX`` characters
    have too many variants and are joined on their pieces.  No match is lost.
    Null names and keywords match nothing.  No side of these joins is broadcast:
    each grows with the keywords or the names, by more than a plan can tell."""
    d = distance
    kw = keywords.select(F.lower(F.col(keywords.columns[0])).alias("keyword")).filter("keyword IS NOT NULL").distinct()
    n = F.length("keyword")
    probes = (kw.withColumn("size", F.explode(F.sequence(F.greatest(n - d, F.lit(0)), n + d))).withColumn("p", F.explode(_pieces(F.col("size"), d)))
              .withColumn("lo", F.greatest(F.col("p.at") - d, F.lit(0))).withColumn("hi", F.least(F.col("p.at") + d, n - F.col("p.n"))).filter("lo <= hi")
              .withColumn("at", F.explode(F.sequence("lo", "hi")))
              .select("keyword", "size", F.col("p.piece").alias("piece"), F.substring("keyword", F.col("at") + 1, F.col("p.n")).alias("text")).distinct())
    on = ["size", "piece", "text"]
    pieces = index if index is not None else name_index(graph, d)
    seen = materialize(pieces.join(probes.select(*on).distinct().hint("merge"), on, "left_semi"))
    near = seen.filter(F.col("size") <= VARIANT_MAX).select("node_table", "id", "name").distinct()
    pairs = _close_names(near.select("name", F.length("name").alias("size")).distinct(), kw.withColumn("size", n).filter(n <= VARIANT_MAX + d), d)
    long = seen.filter(F.col("size") > VARIANT_MAX).join(probes.hint("merge"), on).select("keyword", "node_table", "id", "name").distinct()

    def scored(rows: DataFrame) -> DataFrame:
        return rows.withColumn("distance", F.levenshtein("name", "keyword", d)).filter("distance >= 0")

    short = scored(pairs).join(near.hint("merge"), "name").select("keyword", "node_table", "id", "name", "distance")
    return short.unionByName(scored(long))


def keyword_seeds(graph: PropertyGraph, keywords: DataFrame, distance: int = 0) -> DataFrame:
    """Entity ids whose lower-cased name is one of the keywords, or within
    ``distance`` edits of one."""
    if distance:
        return keyword_matches(graph, keywords, distance).select("id").distinct()
    kw = keywords.select(F.lower(F.col(keywords.columns[0])).alias("kw")).distinct()
    return graph.entities.join(kw, F.lower(F.col("name")) == F.col("kw"), "left_semi").select("id")


def keyword_retrieve(graph: PropertyGraph, keywords: DataFrame, depth: int = 2, limit: int = 30, distance: int = 0) -> DataFrame:
    """Keywords -> entities by name -> rel-map triplets.  The seeds are written
    once: every branch of the walk reads them."""
    return traverse.rel_map(graph, materialize(keyword_seeds(graph, keywords, distance)), depth, limit)


def hybrid_retrieve(graph: PropertyGraph, query: Sequence[float], k: int = vector.TOP_K,
                    depth: int = 2, limit: int = 30) -> DataFrame:
    """Vector hits first, then graph hits, de-duplicated by node id (first wins).

    Graph hits are the triplets of walks from the entities the vector hits
    mention; their node is the triplet's source chunk.
    Output: node_id, origin, pos, score, text.
    """
    hits = vector.topk(graph.chunks, query, k, graph.embed_dim, cols=("id",))
    seeds = entities_of_chunks(graph, hits).select(F.col("entity_id").alias("id"))
    trip = traverse.rel_map(graph, seeds, depth, limit, with_source=True)
    # graph hits in walk order; bounded by limit * depth rows
    g = trip.filter(F.col("triplet_source_id").isNotNull()).select(
        F.col("triplet_source_id").alias("node_id"), "path", "hop",
        F.concat_ws(" ", "src_name", "label", "dst_name").alias("text"))
    # text only for the k hits: they are the side the planner broadcasts
    vec = hits.join(graph.chunks.select("id", "text"), "id").select(F.col("id").alias("node_id"), F.lit(0).alias("origin_rank"),
                      F.col("rank").cast("long").alias("pos"), F.col("similarity").alias("score"), "text")
    gr = g.select("node_id", F.lit(1).alias("origin_rank"),
                  F.row_number().over(Window.orderBy("path", "hop")).cast("long").alias("pos"),
                  F.lit(None).cast("double").alias("score"), "text")
    both = vec.unionByName(gr)
    best = both.groupBy("node_id").agg(F.min(F.struct("origin_rank", "pos", "score", "text")).alias("b"))
    return best.select("node_id", F.when(F.col("b.origin_rank") == 0, F.lit("vector")).otherwise(F.lit("graph"))
                       .alias("origin"), F.col("b.pos").alias("pos"), F.col("b.score").alias("score"),
                       F.col("b.text").alias("text"))


def vector_triplets(graph: PropertyGraph, query: Sequence[float], k: int = vector.TOP_K) -> DataFrame:
    """Triplets ranked by their source chunk's similarity to the query (top k)."""
    trip = lookup.triplet_edges(graph)
    scored_chunks = graph.chunks.filter(vector.valid_vector(F.col("embedding"), graph.embed_dim)).select(
        F.col("id").alias("triplet_source_id"),
        vector.cosine_to_literal(F.col("embedding"), query).alias("similarity"))
    return (trip.join(scored_chunks, "triplet_source_id")
            .orderBy(F.desc("similarity"), "src", "label", "dst", "src_table", "dst_table").limit(k))


def hybrid_triplets(graph: PropertyGraph, query: Sequence[float], keywords: Keys,
                    k: int = vector.TOP_K) -> DataFrame:
    """Embedding-ranked triplets plus keyword triplets, duplicates removed."""
    cols = ["src", "label", "dst"]
    a = vector_triplets(graph, query, k).select(*cols)
    b = lookup.triplets(graph, entity_names=keywords).select(*cols)
    return a.unionByName(b).dropDuplicates(cols)
