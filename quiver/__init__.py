"""quiver: property-graph, triple-store and vector retrieval on Spark DataFrames.

A graph is a handful of plain DataFrames (entities, chunks, edges, mentions for
the property graph; nodes and links for the triple store).  Every operator is a
composition of DataFrame/SQL operations, so Catalyst plans it and it runs on
however many executors the session has.
"""

from quiver.model import PropertyGraph, TripleGraph

__all__ = ["PropertyGraph", "TripleGraph"]
