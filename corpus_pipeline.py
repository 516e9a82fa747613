"""A corpus pipeline: five stages over ``documents``, each written and reread as the next one's input.

Toxicity and quality rules drop documents, line dedup rewrites texts, near-dedup keeps one document
of each group, and packing lays what is left out in training sequences.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import shielded, table, unshielded, written
from tidegrid.llm.line_dedup import drop_frequent_lines
from tidegrid.llm.packing import pack
from tidegrid.llm.quality import compression_bands
from tidegrid.llm.simhash import one_of_each
from tidegrid.llm.toxicity import toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what scores below 0.5 under weights learnt from all labels."""
    inner, names = shielded(docs, ("doc_id", "text"))
    return unshielded(toxicity(inner, table(spark, sf_dir, "labels")).where("predicted = 0"), names)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what passes the base rules and the compression bands."""
    inner, names = shielded(docs, ("doc_id", "text"))
    return unshielded(compression_bands(inner).where("kept"), names)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rewrites texts without the lines found in 10 or more documents; n_chars follows."""
    inner, names = shielded(docs, ("doc_id", "text"))
    rewritten = unshielded(drop_frequent_lines(inner, min_docs=10), names)
    return rewritten.withColumn("n_chars", F.length("text").cast("long"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of documents linked by SimHash (three-word shingles, 3 bits), the smallest id's row."""
    return one_of_each(docs, shingle=3, max_bits=3)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return pack(docs)


STAGES = [("toxicity", drop_toxic), ("quality_rules", drop_low_quality),
          ("line_dedup", drop_shared_lines), ("simhash_near_dedup", keep_one_of_each),
          ("packing", pack_sequences)]

# Learnt weights, compression and tokens are beyond SQL: tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
