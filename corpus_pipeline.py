"""A training corpus from raw documents: each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.common import fresh, table
from fieldlens.llm.language import keep_identified, learned
from fieldlens.llm.line_windows import dedup_lines
from fieldlens.llm.minmax import WIDTH, keep_one
from fieldlens.llm.mixture import mixed
from fieldlens.llm.spaced_seeds import decontaminate
from fieldlens.session import discard, stored


def in_one_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language to at least a half, go.

    The languages are learned from ``docs``; if none has a usable lang, only documents without a letter go.
    """
    return keep_identified(docs, learned(docs))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated three-line windows are cut; a document that loses its last word goes.

    n_chars follows the text that is left; all other columns stay as they are.
    """
    removed = F.col(fresh(docs, "n_removed_lines"))
    cut = dedup_lines(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast("long"))
    return cut.filter((removed == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]")).select(docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of op6's graph stays; shingles of two words, as in op6's contract.

    Five words would keep apart most of the near copies that differ in scattered words.
    """
    return keep_one(docs, width=WIDTH)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go (null and empty texts overlap with none); repeated rows share their fate."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once per copy that its source's target gives it, with the number of the copy in an additional last column.

    Rows equal in doc_id, source and text count as one document with the copies of them all; a null source is a source.
    """
    return mixed(docs)


STAGES = [
    ("language", in_one_language),
    ("line dedup", without_repeated_lines),
    ("near duplicates", one_of_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixture", mixed_sources),
]

# Language models and similarity graphs are no SQL; the stages are tested against direct computations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage is written to the shared folder and read again.

    Null texts and texts without a letter go in the first stage, one of several equal rows stays in the third. Columns
    beyond those of documents pass through, whatever their names. An empty table gives an empty result.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, _ = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            discard(before)
        before = docs
    return docs
