"""Queries of this subpackage, as ``__spark_entry__.py`` registers them."""

from __future__ import annotations

import importlib

#: Query name -> module that holds a function of that name.
MODULES = {
    "op1_quality_rules": "quality_rules",
    "op2_piece_sampling": "piece_sampling",
    "op3_reply_trees": "reply_trees",
    "op4_substring_dedup": "substring_dedup",
    "op5_template_decontamination": "decontaminate",
    "op6_recompression": "recompression",
    "op7_near_dedup": "near_dedup",
    "op8_quality_model": "quality_model",
    "op9_pseudonyms": "pseudonyms",
    "op10_secret_scan": "secret_scan",
    "op11_fill_in_middle": "fill_middle",
    "op12_tokenizer_alignment": "alignment",
    "op13_vector_packing": "packing",
}

QUERIES = {name: getattr(importlib.import_module(f"quiver.llm.{module}"), name) for name, module in MODULES.items()}
#: SQL for the rows, where SQL can express them (a module's ORACLE).
ORACLES = {name: m.ORACLE for name, module in MODULES.items()
           if hasattr(m := importlib.import_module(f"quiver.llm.{module}"), "ORACLE")}
