"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns
of documents. run() writes each stage's result into the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.llm.common import free_name, table, word_count, written
from cladeframe.llm.decontaminate import drop_contaminated
from cladeframe.llm.line_dedup import dedup_lines
from cladeframe.llm.mixing import mix_documents
from cladeframe.llm.near_copies import keep_one
from cladeframe.llm.quality import keep_good


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, with the text of their good lines. Null, empty and very short texts go; very long ones are
    judged whole; repeated rows all stay or all go; there are no ties. An empty table stays empty. Columns keep their names."""
    return _counted(keep_good(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go, by (doc_id, place); a document left without a word goes with them, one
    that had none before stays. Null and empty texts stay; very long ones are windowed whole; repeated rows are one document
    here and all stay; equal ids are ordered by a hash of the row. An empty table stays empty. Other columns are carried along."""
    mark = free_name(docs.columns, "lines_removed")
    out = dedup_lines(docs, mark=mark)
    return _counted(out.where((F.col(mark) == 0) | (word_count(F.col("text")) > 0)).drop(mark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: those linked by sharing 0.8 of their five-word shingles or more,
    the one with the smallest doc_id (nulls last, ties by a hash of the row). Null texts and texts without words are copies of
    each other; very long texts are compared whole; of repeated rows one stays. An empty table stays empty. Other columns are
    carried along."""
    return keep_one(docs, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of ten words of a benchmark item go. Null and empty texts stay; very long ones are looked
    through whole; repeated rows all stay or all go; there are no ties. Empty tables on either side remove nothing. Other columns
    are carried along."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each document and epoch, with the words it takes. Null and empty texts take none and go; a very long
    text that the budget cuts gives its first words; equal or null ids stand at one place and share what the cut leaves;
    repeated rows each count. An empty table stays empty. Columns called epoch or words are kept, and the new ones renamed."""
    return mix_documents(docs)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("simhash near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("source mixing", mixing)]
#: The fingerprints of the third stage are XXH64 hashes, which SQL engines don't share.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
