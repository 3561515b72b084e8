"""Readers and writers: driver tables, graph snapshots, files, edge-list export."""
