"""Graphs derived from the input tables, and the registered query catalog."""
