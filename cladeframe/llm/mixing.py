"""Mixing sources to target weights, by hash-random keys and distributed prefix sums.

Every document gets a random key, the MD5 of a seed and its id. In each source the documents stand in key order, and the
mix takes whole epochs and then the prefix of that order that fills the source's exact budget. The prefix sums run over
sums of key ranges (the key's first digits), which are aggregated before any shuffle; only the range that holds the cut
is split further, so no task sorts a source.

Targets share `share` of all words by weight; no source gives more than max_epochs times its words, and what is above
goes to the others by weight (water filling, solved over the table of sources).

Cases: a null or empty text has 0 words. A null source is a source of its own, the last. Documents with equal keys
(equal or null ids) stand at one place and share what the cut leaves them in proportion to their words, rounded down.
A source without words has target 0. An empty table gives an empty result. Other columns are ignored by
mix_assignments and kept by mix_documents, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small, word_count, words, written

DIGITS = (3, 6, 32)


def random_key(id_col: str, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def source_targets(sized: DataFrame, weights: Sequence[float], share: float, max_epochs: int) -> DataFrame:
    """(source, source_size, target) from (source, size): one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")
    out = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    out = out.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place))
    out = out.withColumn("most", (F.col("source_size") * max_epochs).cast("double"))
    out = out.withColumn("ratio", F.col("most") / F.col("weight"))
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    out = out.withColumn("level", level).withColumn("n", F.row_number().over(by_ratio))
    found = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("n", "level"))).over(everything)["level"]
    out = out.withColumn("found", found)
    target = F.when(F.col("found").isNull(), F.col("most")).otherwise(F.least("most", F.col("found") * F.col("weight")))
    return out.select("source", "source_size", target.alias("target"))


def source_cuts(sized: DataFrame, targets: DataFrame, max_epochs: int) -> DataFrame:
    """Adds (epochs, cut_key, cut_size, cut_left) to each source: whole epochs, then all keys below cut_key, then
    cut_left of the cut_size words at cut_key. cut_key is null where whole epochs fill the budget."""
    epochs = F.when(F.col("source_size") == 0, 0).otherwise(F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_epochs)))
    cuts = targets.withColumn("epochs", epochs.cast("long"))
    cuts = cuts.withColumn("left", F.floor("target").cast("long") - F.col("epochs") * F.col("source_size")).withColumn("prefix", F.lit(""))
    upto = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    for digits in DIGITS:
        cuts = small(written(cuts, "mix-cuts"))
        open_cuts = cuts.where(F.col("left") > 0).select(F.col("source").alias("s"), "prefix", "left")
        inside = sized.join(open_cuts, sized["source"].eqNullSafe(F.col("s")) & F.col("key").startswith(F.col("prefix")))
        sums = inside.groupBy("source", F.substring("key", 1, digits).alias("part"), "left").agg(F.sum("size").alias("part_size"))
        sums = sums.withColumn("before", F.coalesce(F.sum("part_size").over(upto), F.lit(0)))
        hit = sums.where((F.col("before") < F.col("left")) & (F.col("before") + F.col("part_size") >= F.col("left")))
        hit = hit.select(F.col("source").alias("s"), "part", "part_size", (F.col("left") - F.col("before")).alias("in_part"))
        cuts = cuts.join(hit, cuts["source"].eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", "target", "epochs", F.coalesce("in_part", F.lit(0)).alias("left"), F.coalesce("part", F.lit("")).alias("prefix"), "part_size"
        ).withColumnRenamed("part_size", "cut_size")
        if digits != DIGITS[-1]:
            cuts = cuts.drop("cut_size")
    return cuts.select("source", "source_size", "target", "epochs", F.nullif("prefix", F.lit("")).alias("cut_key"), "cut_size", F.col("left").alias("cut_left"))


def taken_words(size: Column, key: Column) -> Column:
    part = F.when(key < F.col("cut_key"), size).when(key == F.col("cut_key"), F.floor(F.col("cut_left") * size / F.col("cut_size")).cast("long"))
    return F.col("epochs") * size + F.coalesce(part, F.lit(0))


def mix_cuts(docs: DataFrame, weights: Sequence[float], share: float, max_epochs: int, seed: str, id_col: str, text_col: str, source_col: str) -> tuple[DataFrame, DataFrame]:
    """The slim written table (id, source, size, key) of docs, and the cuts of its sources."""
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), random_key(id_col, seed).alias("key"))
    sized = written(sized, "mix-sizes")
    targets = source_targets(sized, weights, share, max_epochs)
    return sized, small(written(source_cuts(sized, targets, max_epochs), "mix-cuts"))


def mix_assignments(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, taken) for every row."""
    sized, cuts = mix_cuts(docs, weights, share, max_epochs, seed, id_col, text_col, source_col)
    cuts = cuts.withColumnRenamed("source", "s")
    out = sized.join(cuts, sized["source"].eqNullSafe(F.col("s")))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", taken_words(F.col("size"), F.col("key")).alias("taken"))


def mix_documents(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: the columns of docs, one row per document and epoch, and `epoch` and `words`, the words it takes.

    The text of the one document that a source's budget cuts is shortened to these words, joined by one space.
    If docs has a column of one of these names, the new one is mix_epoch or mix_words.
    """
    names = docs.columns
    _, cuts = mix_cuts(docs, weights, share, max_epochs, seed, id_col, text_col, source_col)
    cuts = cuts.withColumnRenamed("source", "s").select("s", "epochs", "cut_key", "cut_size", "cut_left")
    row = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), word_count(docs[text_col]).alias("size"), random_key(id_col, seed).alias("key"))
    out = row.join(cuts, F.col("row")[source_col].eqNullSafe(F.col("s")))
    out = out.withColumn("taken", taken_words(F.col("size"), F.col("key"))).where("taken > 0")
    out = out.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))))
    out = out.withColumn("words", F.least("size", F.col("taken") - (F.col("epoch") - 1) * F.col("size")))
    text = F.col("row")[text_col]
    cut = F.array_join(F.slice(words(text), 1, F.col("words").cast("int")), " ")
    kept = F.when(F.col("words") < F.col("size"), cut).otherwise(text)
    return out.select(*[kept.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in names], *[F.col(c).alias(f"mix_{c}" if c in names else c) for c in ("epoch", "words")])
