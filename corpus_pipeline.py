"""From raw documents to packed training sequences: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.llm.common import stage, table
from callsift.llm.line_dedup import dedup_lines
from callsift.llm.ngram_join import keep_one
from callsift.llm.packing import best_fit_packing
from callsift.llm.quality import keep_good
from callsift.llm.suffix_dedup import remove_repeats


def _recounted(docs: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, with n_chars (where there is one) counted anew."""
    if "n_chars" in like.columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType))
    return docs.select(*like.columns)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier similar line makes redundant; those that lose every line go."""
    cut = dedup_lines(docs).where(r"n_removed = 0 or text rlike '\\S'")
    return _recounted(cut, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares three quarters of its five-word shingles."""
    return keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings of 50 bytes that a document with a smaller id has too."""
    return _recounted(remove_repeats(docs), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, placed in sequences of at most 2048 tokens."""
    return best_fit_packing(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("best-fit packing", packing),
]

#: Classifiers, similarity and packing are beyond SQL; tests hold the three dedup stages against plain versions row by row, the
#: quality stage against the scores of its own classifier, and packing against its bounds.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
