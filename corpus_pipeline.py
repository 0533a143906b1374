"""Corpus pipeline: five stages over ``documents``, from raw texts to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows the one before it
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import mixing, packing, quality_rules, simhash, substring_dedup
from ledgerloom.llm.common import saved, table
from ledgerloom.llm.queries import MIX_CYCLE, SIMHASH_BITS, SIMHASH_SHINGLE, WINDOW_WORDS


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep."""
    return quality_rules.filter_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the one of least id, of each SimHash component."""
    return simhash.keep_one(docs, SIMHASH_BITS, SIMHASH_SHINGLE)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document holds; emptied documents go."""
    out = substring_dedup.dedup(docs, WINDOW_WORDS)
    words, removed = (F.col(f"`{c}`") for c in out.columns[len(docs.columns):][:2])
    emptied = (removed > 0) & (removed == words)
    changed = removed > 0
    return (out.filter(~emptied)
            .withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")))
            .select(*(F.col(f"`{c}`") for c in docs.columns)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix(docs, lambda s: mixing.cyclic_weights(s, MIX_CYCLE))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequence and offset of every piece of every document."""
    return packing.pack_documents(docs, packing.CAPACITY)


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_duplicates),
          ("substring_dedup", substrings), ("source_mixing", mix_sources),
          ("best_fit_packing", pack)]

#: A learned list and the tokens have no SQL form; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = saved(docs, f"stage-{name}")
    return docs
