"""Exact dedup by skew-safe combining.

Texts are equal when they are identical after lower-casing A-Z. Three stages find the groups of equal texts, and each
compares whole texts, with a 256-bit digest in front that only deals them out:

1. every task combines the equal texts among its own rows (the partial aggregation of the first grouping);
2. what the tasks found meets by (salt, digest, text), the salt being the number of the task modulo `salts`, so that a
   text which every task holds is spread over `salts` places;
3. the winners of the salts, `salts` rows a text at most, meet by digest and are combined by text.

A row finds its group by the digest alone where all rows of that digest hold one text, which the third stage has
compared; rows of digests that several texts share find theirs by the text too. So no text is shuffled for the way back,
and that join is one on slim rows, which Spark splits where a group is large.

Cases: a null text counts as empty. The row with the largest id stays (smallest=True: the smallest); null ids come last. Rows of equal text and
equal id are ties: one of them stays, in drop_duplicates the one with the largest hash of its values. Repeated rows are
such ties. Very long texts are compared whole. An empty table gives an empty result. Other columns are ignored by
duplicate_groups and kept by drop_duplicates, whatever their names. Native: DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, small, value_key, written

SALTS = 32


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _contents(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    return rows.withColumn("digest", digest(F.col("text")))


def content_groups(rows: DataFrame, salts: int = SALTS, smallest: bool = False) -> DataFrame:
    """(digest, text, keep_id, group_size) from rows (id, digest, text): one row per text."""
    best = F.min if smallest else F.max
    dealt = rows.withColumn("salt", F.spark_partition_id() % salts)
    salted = dealt.groupBy("salt", "digest", "text").agg(best("id").alias("keep_id"), F.count("*").alias("group_size"))
    winners = salted.repartition("digest").groupBy("digest", "text")
    return winners.agg(best("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def duplicate_groups(docs: DataFrame, salts: int = SALTS, smallest: bool = False, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(id_col, keep_id, group_size, kept, digest): a row for each row of docs."""
    rows = _contents(docs, id_col, text_col, digest)
    groups = content_groups(rows, salts, smallest)
    # max of one value where a digest has one text, as it nearly always has
    slim = groups.groupBy("digest").agg(F.count("*").alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))
    slim = written(slim, "dedup-groups")
    contested = slim.where("texts > 1").select("digest")
    copies = rows.groupBy("id", "digest").agg(F.count("*").alias("copies"))
    found = copies.join(slim.where("texts = 1").drop("texts"), "digest")
    if not contested.isEmpty():
        among = rows.join(small(written(contested, "dedup-contested")), "digest", "left_semi")
        own = content_groups(among, salts, smallest)
        found = found.unionByName(among.groupBy("id", "digest", "text").agg(F.count("*").alias("copies")).join(own, ["digest", "text"]).drop("text"))
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return each.select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), "digest")


def drop_duplicates(docs: DataFrame, salts: int = SALTS, smallest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, one for each text."""
    names = docs.columns
    groups = content_groups(_contents(docs, id_col, text_col, sha256), salts, smallest).select("digest", "text", "keep_id")
    rows = docs.select(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("same"), F.col(id_col).alias("id"), F.struct(*[docs[c] for c in names]).alias("row"), *value_key(*names))
    rows = rows.withColumn("d", sha256(F.col("same")))
    match = (rows["d"] == groups["digest"]) & (rows["same"] == groups["text"]) & rows["id"].eqNullSafe(groups["keep_id"])
    kept = rows.join(groups, match).groupBy("d", "same").agg(F.max_by("row", F.struct("k1", "k2")).alias("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in names])
