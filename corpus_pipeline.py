"""Corpus pipeline: quality, line dedup, near-duplicate texts, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on every row it gets; all but the
last return the columns of ``documents``.  ``run`` writes each stage's rows to the
shared folder and reads them back before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import common, decontamination, lines, near, packing, quality


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of at least the threshold; labels of ``labels`` teach it."""
    return quality.accept(docs, common.table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that later occurrences of three-line windows cover."""
    found = lines.dedup_lines(docs)
    length = F.length("text").cast("long")
    return found.select(*(length.alias(c) if c == "n_chars" else common.col(c) for c in docs.columns))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the least doc_id."""
    return near.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of ``benchmark``."""
    return decontamination.drop_leaks(docs, common.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in token sequences, as op9 returns them."""
    return packing.with_digest(packing.pack(docs))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: A fitted classifier can't be stated in SQL; tests/llm/test_pipeline.py holds ``run`` against plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
