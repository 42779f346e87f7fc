"""A corpus pipeline of five stages: quality rules, line dedup, near duplicates, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept. Documents leave when the quality
rules reject them, when earlier documents hold all their lines, when another document of their group of near copies stays, or
when mixing gives them no copy. Lines that an earlier document holds leave the text. The last stage returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm import line_dedup, mixing, ngram_join, packing, quality
from cohortflow.llm.queries import WEIGHTS, domain
from cohortflow.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the perplexity bands keep."""
    return quality.keep_good(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document holds, if any words are left; ``n_chars`` follows the text."""
    left = line_dedup.drop_repeated_lines(docs).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("n_chars", F.length("text").cast("long"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest ID."""
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their domains ask; labels are those of the source documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    sources = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mixing.take_copies(docs, mixing.mix_to_targets(docs, labels, domain(), WEIGHTS, "good", labelled=sources))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences that hold the sources in their proportions."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", repeated_lines),
    ("ngram_jaccard", near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# SQL can express neither the perplexity model nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the rows of one are written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
