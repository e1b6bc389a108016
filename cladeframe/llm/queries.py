"""Registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .common import table
from .decontaminate import contamination
from .exact_dedup import duplicate_groups
from .filter_audit import audit
from .html_text import main_text
from .licenses import scan_licenses
from .line_dedup import dedup_lines
from .merkle import COLUMNS, manifest, proofs, tampered
from .mixing import mix_assignments
from .pii import BASE, personal_data
from .quality import judged
from .simhash import components
from .substring_dedup import remove_repeated_passages
from .suffix_dedup import remove_repeated_bytes


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that lie in a window of 35 found anywhere else too are removed."""
    out = remove_repeated_passages(table(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_lines: \\n-split lines of the text (null: none); n_removed: those removed; kept_sha256: of the text that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(docs.withColumn("n_lines", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long")), width=3)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of words, symbols and repeats, the base rules' verdict and the method's."""
    out = judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words hit by benchmark windows of ten, and the items that hit; n_near_items: items with near matches only."""
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), F.size("near_items").cast("long").alias("n_near_items"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that lie in a string of 400 found anywhere else too are removed."""
    out = remove_repeated_bytes(table(spark, sf_dir, "documents"), window=400)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed_spans").cast("long").alias("n_spans"), F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data by kind: base spans, and all spans, those that the model adds included."""
    out = personal_data(table(spark, sf_dir, "documents"))
    digest = lambda name: F.array_join(F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [of_kind(k) for k in BASE]
    return out.select("doc_id", *counts, F.sha2(digest("base"), 256).alias("base_sha256"), digest("spans").alias("spans"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page, without the site's template."""
    out = main_text(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-bit fingerprints, and the smallest doc_id that is linked by steps of three bits or fewer."""
    out = components(table(spark, sf_dir, "documents"), shingle=3)
    return out.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mix_assignments(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, max_epochs=2)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of base phrases, and labels of licenses whose notices the texts hold."""
    out = scan_licenses(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's leaf, the roots above it, a hash of its proof, and whether a tampered table's leaf still gives the root."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    out = proofs(manifest(docs, changed=tampered(docs)))
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes, by language, order of the filters and step."""
    return audit(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with the largest doc_id among the rows of equal text, and how many these are."""
    out = duplicate_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
