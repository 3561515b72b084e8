"""Corpus pipeline: quality rules, near-duplicates, decontamination, personal
data, tokenisation, over the whole ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quiver.llm.common import materialize, read_docs
from quiver.llm.decontaminate import remove_contaminated
from quiver.llm.near_dedup import near_dedup
from quiver.llm.piece_sampling import sample_pieces
from quiver.llm.pseudonyms import PUBLIC_KEY, pseudonymise
from quiver.llm.quality_rules import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their language's perplexity band."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with 5-word shingles alike at 0.8 or more."""
    return near_dedup(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, or a re-parameterised one."""
    return remove_contaminated(docs, read_docs(spark, sf_dir, "item_id", "text", table="benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; n_chars follows the text."""
    return pseudonymise(docs, PUBLIC_KEY, length="n_chars" if "n_chars" in docs.columns else None, counts=False)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, n_bytes, lossless and the sampled piece ids."""
    return sample_pieces(docs)


STAGES = [("quality_rules", quality), ("near_dedup", near_duplicates), ("decontamination", decontamination),
          ("pseudonyms", personal_data), ("piece_sampling", tokens)]

#: SQL can express neither the perplexity model nor the sampled pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_docs(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
