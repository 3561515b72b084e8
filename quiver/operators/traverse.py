"""Bounded path expansion, rel-maps and motif matching.

A walk of up to ``depth`` hops is ``depth`` equi-joins of the frontier with the
edge list, unrolled in one logical plan.  Only ids travel along the path; names
and other properties are joined after the limit, on at most ``limit`` paths.
Hub nodes make some join keys hot: AQE's skew-join splits those partitions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.model import MENTIONS, PropertyGraph, TripleGraph
from quiver.operators.keys import NOWHERE, Keys, attach, restrict
from quiver.session import materialize
from quiver.sources.adjacency import Adjacency, node_key

REL_MAP_DEPTH = 2
REL_MAP_LIMIT = 30

_HOP = ("struct<src_table:string,src:string,label:string,dst_table:string,dst:string,"
        "triplet_source_id:string>")


def walk_edges(graph: PropertyGraph) -> DataFrame:
    """Edges that take part in expansion: label present and not MENTIONS
    (a NULL label fails ``label <> 'MENTIONS'`` under three-valued logic)."""
    return graph.edges.filter(F.col("label") != F.lit(MENTIONS)).select(
        "src_table", "src", "label", "dst_table", "dst", "triplet_source_id")


def _walk_edges(edges: DataFrame) -> DataFrame:
    if "triplet_source_id" not in edges.columns:
        edges = edges.withColumn("triplet_source_id", F.lit(None).cast("string"))
    return edges.select("src_table", "src", "label", "dst_table", "dst", "triplet_source_id")


def _start(seeds: DataFrame) -> DataFrame:
    return seeds.select(
        "start_table", "start",
        F.col("start_table").alias("cur_table"), F.col("start").alias("cur"),
        F.array("start").alias("path_seq"), F.array("start_table").alias("tables_seq"),
        F.array().cast(f"array<{_HOP}>").alias("hops_arr"),
        F.array(F.concat_ws("\u0001", "start_table", "start")).alias("visited"),
        F.lit(0).alias("hops"))


def _step(frontier: DataFrame, e: DataFrame, hop: int, simple: bool) -> DataFrame:
    step = frontier.join(e, (F.col("cur_table") == F.col("src_table")) & (F.col("cur") == F.col("src")))
    if simple:
        step = step.filter(~F.array_contains("visited", F.concat_ws("\u0001", F.col("dst_table"), F.col("dst"))))
    return step.select("start_table", "start", *[v.alias(k) for k, v in _extended(hop).items()])


def _extended(hop: int) -> dict:
    """A frontier row's columns after it took the joined edge."""
    return {
        "cur_table": F.col("dst_table"), "cur": F.col("dst"),
        "path_seq": F.concat("path_seq", F.array(F.coalesce("label", F.lit("")), "dst")),
        "tables_seq": F.concat("tables_seq", F.array("dst_table")),
        "hops_arr": F.concat("hops_arr", F.array(F.struct("src_table", "src", "label", "dst_table", "dst", "triplet_source_id"))),
        "visited": F.concat("visited", F.array(F.concat_ws("\u0001", "dst_table", "dst"))),
        "hops": F.lit(hop)}


def _finish(df: DataFrame) -> DataFrame:
    return df.select("start_table", "start", "hops", F.array_join("path_seq", "|").alias("path"),
                     F.array_join("tables_seq", "|").alias("path_tables"), "path_seq", "tables_seq",
                     "hops_arr", F.col("cur_table").alias("end_table"), F.col("cur").alias("end"))


def expand(edges: DataFrame, seeds: DataFrame, depth: int, simple: bool = False) -> DataFrame:
    """Every walk of 1..depth hops from ``seeds(start_table, start)``.

    This materialises all walks (use it when all are wanted); for the first
    ``limit`` walks use :func:`top_walks`, which never builds the full set.
    Columns: start_table, start, hops, path ('|'-joined ids and labels),
    path_tables, path_seq/tables_seq (the sort key), hops_arr, end_table, end.
    ``simple=True`` refuses to revisit a node.
    """
    if depth < 1:
        raise ValueError("depth must be >= 1")
    e = _walk_edges(edges)
    frontier = _start(seeds)
    levels = []
    for hop in range(1, depth + 1):
        frontier = _step(frontier, e, hop, simple)
        levels.append(frontier)
    return _finish(reduce(DataFrame.unionByName, levels))


ORDER = ["path_seq", "tables_seq"]


def top_walks(edges: DataFrame, seeds: DataFrame, depth: int, limit: int, simple: bool = False) -> DataFrame:
    """The first ``limit`` walks (1..depth hops) in (path_seq, tables_seq) order.

    Exact, and one lazy plan.  A walk sorts right before its own extensions, so
    a walk that is not among the first ``limit`` found so far cannot lead to
    one that is: each hop keeps only ``limit`` walks.  The planner knows that
    bound and broadcasts them against a scan of the edges; only the first hop
    (distinct non-NULL seeds with the edges) may shuffle.  A kept walk goes
    through the next hop's join too, matched to a sentinel edge, so every hop
    is planned and run once.
    """
    if depth < 1:
        raise ValueError("depth must be >= 1")
    e = _walk_edges(edges)
    seeds = seeds.select("start_table", "start").filter(F.col("start").isNotNull() & F.col("start_table").isNotNull()).distinct()
    found = _step(_start(seeds), e, 1, simple).orderBy(*ORDER).limit(limit)
    sentinel = edges.sparkSession.createDataFrame([(NOWHERE, NOWHERE)], "src_table string, src string")
    for c in ("label", "dst_table", "dst", "triplet_source_id"):
        sentinel = sentinel.withColumn(c, F.lit(None).cast("string"))
    beyond = e.unionByName(sentinel)
    for hop in range(2, depth + 1):
        both = found.withColumn("_go", F.explode(F.when(F.col("hops") == hop - 1, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
        at = [F.when(F.col("_go"), F.col(c)).otherwise(F.lit(NOWHERE)) for c in ("cur_table", "cur")]
        met = both.withColumn("_t", at[0]).withColumn("_i", at[1]).join(beyond, (F.col("_t") == F.col("src_table")) & (F.col("_i") == F.col("src")))
        if simple:
            met = met.filter(~F.col("_go") | ~F.array_contains("visited", F.concat_ws("\u0001", F.col("dst_table"), F.col("dst"))))
        longer = _extended(hop)
        found = (met.select("start_table", "start", *[F.when(F.col("_go"), v).otherwise(F.col(k)).alias(k) for k, v in longer.items()])
                 .orderBy(*ORDER).limit(limit))
    return _finish(found).orderBy(*ORDER)


POINT_KEYS = 1000  # this many seeds or fewer are a literal filter, more are a join


def _first_edges(adjacency: Adjacency, seeds: Keys, limit: int) -> DataFrame:
    """Out-edges of the seeds (ids in any table; ``None`` = all nodes)."""
    e = adjacency.edges(limit)
    if seeds is None:
        return e
    tables = F.array(*[F.lit(t) for t in adjacency.tables])
    if isinstance(seeds, DataFrame):
        ids = seeds.select(F.col(seeds.columns[0]).cast("string").alias("_id")).filter("_id IS NOT NULL").distinct()
    else:
        ids = sorted({str(x) for x in seeds if x is not None})
        if len(ids) * len(adjacency.tables) <= POINT_KEYS:
            return e.filter(F.col("node").isin(["\u0001".join((t, i)) for t in adjacency.tables for i in ids]))
        ids = adjacency.spark.createDataFrame([(i,) for i in ids], "_id string")
    nodes = ids.select(F.explode(tables).alias("_table"), "_id").select(node_key("_table", "_id").alias("node"))
    return e.join(nodes, "node", "left_semi")


def stored_walks(adjacency: Adjacency, seeds: Keys, depth: int, limit: int) -> DataFrame:
    """:func:`top_walks` over a stored adjacency: same rows, same order.

    The first hop never shuffles edges.  Each further hop is a job of its own
    that reads the buckets of the frontier: at most ``limit`` walks come to the
    driver, and their end nodes go back as a literal filter.
    """
    if depth < 1:
        raise ValueError("depth must be >= 1")
    spark, walk_cols = adjacency.spark, ["src_table", "src", "label", "dst_table", "dst", "triplet_source_id"]
    start = _first_edges(adjacency, seeds, limit).select(*walk_cols)
    at = start.withColumns({"start_table": F.col("src_table"), "start": F.col("src"), "path_seq": F.array("src"),
                            "tables_seq": F.array("src_table"), "hops_arr": F.array().cast(f"array<{_HOP}>"),
                            "visited": F.array(node_key("src_table", "src"))})
    found = (at.select("start_table", "start", *[v.alias(k) for k, v in _extended(1).items()])
             .orderBy(*ORDER).limit(limit))
    for hop in range(2, depth + 1):
        found = spark.createDataFrame(found.collect(), found.schema)  # at most ``limit`` rows
        ends = [r[0] for r in found.filter(F.col("hops") == hop - 1).select(node_key("cur_table", "cur")).distinct().collect()]
        if not ends:
            break
        e = adjacency.edges(limit).filter(F.col("node").isin(ends)).select(*walk_cols)
        longer = _step(found.filter(F.col("hops") == hop - 1), e, hop, False)
        found = found.unionByName(longer).orderBy(*ORDER).limit(limit)
    return _finish(found).orderBy(*ORDER)


def seed_nodes(graph: PropertyGraph, ids: Keys) -> DataFrame:
    """Nodes (of any table) whose id is listed; ``None`` = every node."""
    nodes = graph.entities.select("node_table", "id").unionByName(
        graph.chunks.select(F.lit("Chunk").alias("node_table"), "id"))
    nodes = restrict(nodes, "id", ids)
    return nodes.select(F.col("node_table").alias("start_table"), F.col("id").alias("start"))


def rel_map_paths(graph: PropertyGraph, ids: Keys = None, depth: int = REL_MAP_DEPTH,
                  limit: int = REL_MAP_LIMIT, simple: bool = False, adjacency: Adjacency | None = None) -> DataFrame:
    """The first ``limit`` walks in (path_seq, tables_seq) order: hop tuples
    compared left to right, a walk before its extensions.  With ``adjacency``
    (of this graph) the edges are read from it; it holds too few of a node's
    edges for simple paths."""
    if adjacency is not None:
        if simple:
            raise ValueError("simple paths need all edges: not with an adjacency")
        return stored_walks(adjacency, ids, depth, limit)
    return top_walks(walk_edges(graph), seed_nodes(graph, ids), depth, limit, simple)


def rel_map(graph: PropertyGraph, ids: Keys = None, depth: int = REL_MAP_DEPTH,
            limit: int = REL_MAP_LIMIT, ignore_rels: Sequence[str] | None = None,
            with_source: bool = False, adjacency: Adjacency | None = None) -> DataFrame:
    """One triplet per edge of each of the first ``limit`` walks.

    Each edge keeps its own endpoints.  ``ignore_rels`` drops edges after the
    limit, as the path limit counts walks, not edges.  Duplicates across walks
    stay.
    """
    paths = rel_map_paths(graph, ids, depth, limit, adjacency=adjacency)
    hops = paths.select("path", F.posexplode("hops_arr").alias("pos", "h")).select(
        "path", (F.col("pos") + 1).alias("hop"), "h.*")
    if ignore_rels:
        hops = hops.filter(~F.coalesce(F.col("label").isin(list(ignore_rels)), F.lit(False)))
    named = attach(hops, graph.entities.select("node_table", "id", "name"), ["node_table", "id"], "name",
                   {"src_name": ["src_table", "src"], "dst_name": ["dst_table", "dst"]})
    return named.select("path", "hop", "src_table", "src", "src_name", "label", "dst_table", "dst", "dst_name",
                        *(["triplet_source_id"] if with_source else []))


def triple_rel_map(tg: TripleGraph, subjects: Keys = None, depth: int = REL_MAP_DEPTH,
                   limit: int = REL_MAP_LIMIT, adjacency: Adjacency | None = None) -> DataFrame:
    """Walks in the triple store as ``subj, hops, path`` where path is
    ``s|p1|n1|p2|...|o``; an empty subject list gives no rows.  With
    ``adjacency`` (of this store) the links are read from it.

    A walk needs an outgoing link, so the subjects themselves are the seeds
    (no pass over the node table is needed to check they exist)."""
    if adjacency is not None:
        paths = stored_walks(adjacency, subjects, depth, limit)
        return paths.select(F.col("start").alias("subj"), "hops", "path")
    links = tg.links.select(F.lit("n").alias("src_table"), "src",
                            F.col("predicate").alias("label"), F.lit("n").alias("dst_table"), "dst")
    if subjects is None:
        seeds = tg.nodes.select(F.lit("n").alias("start_table"), F.col("id").alias("start"))
    elif isinstance(subjects, DataFrame):
        seeds = subjects.select(F.lit("n").alias("start_table"),
                                F.col(subjects.columns[0]).cast("string").alias("start"))
    else:
        vals = sorted({str(x) for x in subjects if x is not None})
        seeds = tg.links.sparkSession.createDataFrame([("n", v) for v in vals], "start_table string, start string")
    paths = top_walks(links, seeds, depth, limit)
    return paths.select(F.col("start").alias("subj"), "hops", "path")


def triple_rel_map_grouped(tg: TripleGraph, subjects: Keys = None, depth: int = REL_MAP_DEPTH,
                           limit: int = REL_MAP_LIMIT) -> DataFrame:
    """Same walks grouped per subject (the dict-of-lists shape)."""
    return (triple_rel_map(tg, subjects, depth, limit)
            .groupBy("subj").agg(F.sort_array(F.collect_list("path")).alias("paths")))


# ---------------------------------------------------------------- motif match

@dataclass(frozen=True)
class Hops:
    """A variable-length pattern edge: ``lo`` to ``hi`` hops over edges with one
    of ``labels``, through nodes of any table."""
    labels: tuple[str, ...]
    lo: int
    hi: int

    def __post_init__(self):
        if isinstance(self.labels, str) or not self.labels:
            raise ValueError("labels must be a non-empty tuple of labels")
        if not 1 <= self.lo <= self.hi:
            raise ValueError("hops need 1 <= lo <= hi")


def reach_pairs(graph: PropertyGraph, start_table: str, hops: Hops, end_table: str,
                ids: DataFrame | None = None, backward: bool = False) -> DataFrame:
    """Distinct ``(src, dst)`` ids with a walk of ``lo`` to ``hi`` hops from a
    ``start_table`` node to an ``end_table`` node.

    Pairs, not walks: every hop keeps each (origin, node reached) once, so a
    frontier is bounded by the pairs however many walks lead there.  ``ids``
    (one column) limits the origins; with ``backward`` they are the ends, and
    the walk goes against the edges.  A frontier is written once a hop.
    """
    e = graph.edges.filter(F.col("label").isin(list(hops.labels)))
    near, far = ("dst", "src") if backward else ("src", "dst")
    origin, goal = (end_table, start_table) if backward else (start_table, end_table)
    e = e.select(F.col(f"{near}_table").alias("cur_table"), F.col(near).alias("cur"),
                 F.col(f"{far}_table").alias("next_table"), F.col(far).alias("next"))
    first = e.filter(F.col("cur_table") == origin)
    if ids is not None:
        first = first.join(ids.select(F.col(ids.columns[0]).alias("cur")).distinct(), "cur", "left_semi")
    frontier = first.select(F.col("cur").alias("origin"), "next_table", "next")
    levels = []
    for hop in range(1, hops.hi + 1):
        if hop > 1:
            at = frontier.select("origin", F.col("next_table").alias("cur_table"), F.col("next").alias("cur"))
            frontier = at.join(e, ["cur_table", "cur"]).select("origin", "next_table", "next")
        if hop < hops.hi:
            frontier = materialize(frontier.distinct())
        if hop >= hops.lo:
            levels.append(frontier.filter(F.col("next_table") == goal).select("origin", "next"))
    # the last level is reduced here, together with the others
    pairs = reduce(DataFrame.unionByName, levels).distinct()
    return pairs.select(F.col("origin").alias(near), F.col("next").alias(far)).select("src", "dst")


def _hot(frames: Sequence[DataFrame], v: str, heavy: int) -> DataFrame:
    """Values of ``v`` with over ``heavy`` rows in two or more of the frames (at
    most one value per ``heavy`` rows), written once."""
    crowded = [f.groupBy(v).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > heavy).select(v) for f in frames]
    return materialize(reduce(DataFrame.unionByName, crowded).groupBy(v).agg(F.count(F.lit(1)).alias("_rows"))
                       .filter(F.col("_rows") > 1).select(v))


def _meet(frames: Sequence[DataFrame]) -> DataFrame:
    """Edge frames joined on the variables they share."""
    return reduce(lambda x, f: x.join(f, [c for c in f.columns if c in x.columns]), frames)


def match(graph: PropertyGraph, pattern: Sequence[tuple], heavy: int | None = None) -> DataFrame:
    """Match a chain or cycle motif; one row per binding, one id column per variable.

    ``pattern`` is a list of edges ``(a, "A_TABLE", "LABEL", b, "B_TABLE")``; a
    variable named twice binds the same node, which closes cycles.  The label
    ``MENTIONS`` (with ``A_TABLE = "Chunk"``) matches chunk -> entity mentions.
    Variables are bound in first-appearance order, so list the most selective
    edge first.

    Variables are bound one at a time (first-appearance order).  All pattern
    edges between the next variable and already-bound ones are joined on that
    variable first, and the result is joined in on every bound endpoint at
    once, so a closing constraint filters inside the join instead of after a
    fan-out (no all-pairs-within-a-group intermediate).

    In place of a label, :class:`Hops` is an edge of variable length: it binds
    each pair of ends once, however many walks join them.  It is searched from
    its bound variable where there is one, else from ``a``.

    Joining edges that meet in a hub pairs all its neighbours.  With ``heavy``,
    values of the new variable with more than that many rows in two or more of
    the joined edges go another way: from the bindings found so far along one
    edge to the hubs, then the other edges are joined on both their ends.  All
    other values pair at most ``heavy`` rows with each row of one edge.  The
    result is the same.
    """
    if not pattern:
        raise ValueError("empty pattern")
    if heavy is not None and heavy < 1:
        raise ValueError("heavy must be >= 1")

    def edge_frame(i, a, a_tab, label, b, b_tab):
        if isinstance(label, Hops):
            known = [x in bound for x in (a, b)]
            ids = out.select(a if known[0] else b) if any(known) else None
            e = reach_pairs(graph, a_tab, label, b_tab, ids, backward=known == [False, True])
        elif label == MENTIONS:
            # the label-less chunk -> entity relation lives in its own table
            e = graph.mentions.filter((F.lit(a_tab) == F.lit("Chunk")) & (F.col("entity_table") == b_tab)) \
                              .select(F.col("chunk_id").alias("src"), F.col("entity_id").alias("dst"))
        else:
            e = graph.edges.filter((F.col("src_table") == a_tab) & (F.col("dst_table") == b_tab)
                                   & (F.col("label") == label))
        # every edge instance matches (parallel edges give separate bindings)
        return e.select(F.col("src").alias(a), F.col("dst").alias(b)) if a != b else \
            e.filter(F.col("src") == F.col("dst")).select(F.col("src").alias(a))

    order: list[str] = []
    for a, _, _, b, _ in pattern:
        for v in (a, b):
            if v not in order:
                order.append(v)
    a0, at0, l0, b0, bt0 = pattern[0]
    out, bound = None, set()  # nothing is bound while the first edge is made
    out = edge_frame(0, a0, at0, l0, b0, bt0)
    bound = {a0, b0}
    used = {0}
    for v in order:
        if v in bound:
            continue
        incident = [i for i, (a, _, _, b, _) in enumerate(pattern)
                    if i not in used and v in (a, b) and ({a, b} - {v}) <= bound]
        if not incident:
            raise ValueError(f"variable {v!r} is not connected to the earlier pattern")
        if any(isinstance(pattern[i][2], Hops) for i in incident):
            out = materialize(out)  # each search from it is a job: the bindings are not found again for every one
        frames = [edge_frame(i, *pattern[i]) for i in incident]
        used.update(incident)
        loops = [f for f in frames if f.columns == [v]]
        frames = [f for f in frames if f.columns != [v]]
        if not frames:
            raise ValueError(f"variable {v!r} is not connected to the earlier pattern")
        through_hubs = None
        if heavy is not None and len(frames) > 1:
            hot = _hot(frames, v, heavy)
            for f in frames:
                f = f.join(hot, v, "left_semi")
                through_hubs = out.join(f, [c for c in f.columns if c != v]) if through_hubs is None else \
                    through_hubs.join(f, f.columns)
            frames = [f.join(hot, v, "left_anti") for f in frames]
        star = _meet(frames)
        out = out.join(star, [c for c in star.columns if c != v])
        if through_hubs is not None:
            out = out.unionByName(through_hubs)
        for f in loops:
            out = out.join(f, v)
        bound.add(v)
    # edges whose endpoints were both bound before they were reached
    for i, (a, at, lab, b, bt) in enumerate(pattern):
        if i not in used:
            if isinstance(lab, Hops):
                out = materialize(out)
            out = out.join(edge_frame(i, a, at, lab, b, bt), sorted({a, b}))
    return out.select(*order)
