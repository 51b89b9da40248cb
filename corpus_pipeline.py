"""The corpus pipeline: documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.llm.common import stored, table
from tributary.llm.line_dedup import dedup_lines
from tributary.llm.mixing import mixed_rows
from tributary.llm.packing import pack
from tributary.llm.simhash import one_per_component
from tributary.llm.toxicity import learn, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the lexicon is learned from the labelled ones among ``docs``."""
    return without_toxic(docs, learn(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates stay in the first document only."""
    return dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of close fingerprints stays, the one with the smallest id."""
    return one_per_component(docs, shingle=4, max_bits=4)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document that is taken twice is there twice."""
    return mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of 4096, the ids among them."""
    return pack(docs, with_ids=True)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("mixing", mixing), ("packing", packing)]

#: Learned lexicons, XXH64 and tokenizers are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
