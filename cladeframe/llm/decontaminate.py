"""Benchmark decontamination with a distributed positional inverted index.

The test items are cut into windows of `width` words. One pass over the documents writes the index into the shared
folder: the postings (term, document, position) of every word that any item holds, and for each document one posting of
the empty term behind its last word, which tells its length. All else reads the index, not the texts. Each window is
looked up by its `rarest` rarest terms: positions are adjusted by the terms' offsets in the item, and lists are
intersected where a line of one document and item holds all rare terms of a window. What survives is intersected with
the lists of the window's other terms (exact phrase matches). A window is near a place where its rare terms stand at
most `slop` words from where the rarest one puts them, and at least NEAR_SHARE of all its words do.

The tables of terms and windows grow with the test set, not with the documents; they are counted, and broadcast only if
small, as are the keys of documents with candidates. Cases: a null or empty text or item has no words and matches
nothing; an item shorter than a window is one window, and one word that everything holds is looked up like any other.
Repeated rows match alike; items with equal ids count once, items of equal words are looked up once, and an item without
id marks words but is not listed. An empty table on either side gives no matches. A single text must fit a task, not its
postings. Other columns are ignored by matches and kept by drop_contaminated, whatever their names. Native: DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, small, value_key, words, written

#: Between the words of lower-cased texts.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NEAR_SHARE = 0.8
DOC = ["k1", "k2"]


def tokens(text: Column) -> Column:
    return words(ascii_lower(text), NO_WORD)


def item_words(items: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(row, w): the different word sequences of items; (row, item): which items have them."""
    out = items.select(F.col(item_col).alias("item"), tokens(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    out = out.select(F.xxhash64("w").alias("row"), "w", "item")
    return small(written(out.select("row", "w").distinct(), "items")), small(written(out.select("row", "item").distinct(), "item-ids"))


def document_index(docs: DataFrame, own: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k1, k2, term, pos): the stored postings of the terms of own(w), and of the empty term at the end of each document."""
    terms = own.select(F.explode("w").alias("term")).distinct()
    terms = small(written(terms.union(docs.sparkSession.range(1).select(F.lit("").alias("term"))), "terms"))
    texts = docs.select(*value_key(id_col, text_col), tokens(F.col(text_col)).alias("t"))
    placed = texts.select("k1", "k2", F.posexplode(F.concat("t", F.array(F.lit("")))).alias("pos", "term"))
    return written(placed.join(terms, "term").select("k1", "k2", "term", "pos"), "index")


def window_starts(n: Column, width: int) -> Column:
    return F.sequence(F.lit(0), F.greatest(n - width, F.lit(0)))


def rare_offsets(index: DataFrame, own: DataFrame, width: int, rarest: int) -> DataFrame:
    """(row, at, needed): for each window that can occur at all the offsets of its rarest terms, the rarest first."""
    counted = small(written(index.where("term <> ''").groupBy("term").count(), "term-counts"))
    wins = own.select("row", "w", F.explode(window_starts(F.size("w"), width)).alias("at"))
    parts = wins.select("row", "at", F.posexplode(F.slice("w", F.col("at") + 1, width)).alias("i", "term"))
    order = Window.partitionBy("row", "at").orderBy("n", "term", "i")
    chosen = parts.join(counted, "term", "left").withColumn("n", F.coalesce("count", F.lit(0)))
    chosen = chosen.withColumn("place", F.row_number().over(order)).where(F.col("place") <= rarest)
    offsets = F.array_sort(F.collect_list(F.struct("place", (F.col("at") + F.col("i")).alias("o"))))
    needed = chosen.groupBy("row", "at").agg(F.transform(offsets, lambda x: x["o"]).alias("needed"), F.min("n").alias("least")).where("least > 0")
    return small(written(needed.select("row", "at", "needed"), "needed-terms"))


def met_offsets(index: DataFrame, asked: DataFrame, by: list[str]) -> DataFrame:
    """(by, met): which offsets of asked(k1, k2, term, pos, offset, by) the index holds."""
    docs = small(written(asked.select(*DOC).distinct(), "candidate-documents"))
    held = index.join(docs, DOC, "left_semi").join(asked, [*DOC, "term", "pos"])
    return held.groupBy(*by).agg(F.collect_set("offset").alias("met"))


def lookup(index: DataFrame, own: DataFrame, width: int, rarest: int, slop: int) -> tuple[DataFrame, DataFrame | None]:
    """(k1, k2, row, start, length) of exact matches, and of near ones in rows without exact match; None without slop."""
    needed = rare_offsets(index, own, width, rarest)
    sought = needed.select("row", F.explode("needed").alias("offset")).distinct().join(own, "row").select("row", "offset", F.get("w", F.col("offset")).alias("term"))
    sought = small(written(sought, "sought-terms"))
    lists = index.join(sought, "term").select("k1", "k2", "row", "offset", (F.col("pos") - F.col("offset")).alias("line"))

    lines = lists.groupBy("k1", "k2", "row", "line").agg(F.collect_set("offset").alias("met")).join(needed, "row")
    fits = lines.where((F.size(F.array_except("needed", "met")) == 0) & (F.col("line") + F.col("at") >= 0))
    line = ["k1", "k2", "row", "line"]
    fits = written(fits.groupBy(*line).agg(F.collect_set("at").alias("ats")), "lines")
    size = F.least(F.size("w"), F.lit(width))
    inside = F.array_distinct(F.flatten(F.transform("ats", lambda a: F.sequence(a, a + size - 1))))
    asked = fits.join(own, "row").select(*line, "w", F.explode(inside).alias("offset"))
    asked = asked.select(*line, "offset", F.get("w", F.col("offset")).alias("term"), (F.col("line") + F.col("offset")).alias("pos"))
    whole = fits.join(met_offsets(index, asked, line), line).join(own, "row")
    whole = whole.select(*DOC, "row", "line", "met", size.alias("length"), F.explode("ats").alias("at"))
    whole = whole.where(F.size(F.array_except(F.sequence("at", F.col("at") + F.col("length") - 1), "met")) == 0)
    exact = written(whole.select(*DOC, "row", (F.col("line") + F.col("at")).alias("start"), "length"), "exact-matches")
    if not slop:
        return exact, None

    # lines at most slop apart share a cell: that of one end of their surroundings
    wide = 2 * slop + 1
    cells = F.array_distinct(F.array(F.floor((F.col("line") - slop) / wide), F.floor((F.col("line") + slop) / wide)))
    spread = lists.withColumn("cell", F.explode(cells)).groupBy("k1", "k2", "row", "cell").agg(F.collect_set(F.struct("offset", "line")).alias("met")).where(F.size("met") > 1)
    spread = spread.join(needed, "row").where((F.size("needed") > 1) & (F.size(F.array_except("needed", F.col("met.offset"))) == 0))
    by = lambda o, d: F.exists("met", lambda m: (m["offset"] == o) & m["line"].between(d - slop, d + slop))
    first = F.filter("met", lambda m: (m["offset"] == F.get("needed", F.lit(0))) & F.forall("needed", lambda o: by(o, m["line"])))
    found = spread.select(*DOC, "row", "at", F.explode(first).alias("m")).select(*DOC, "row", "at", F.col("m.line").alias("line")).distinct()
    found = written(found.join(exact.select(*DOC, "row").distinct(), [*DOC, "row"], "left_anti"), "near-candidates")
    whole = [*DOC, "row", "at", "line"]
    asked = found.join(own, "row").select(*whole, "w", F.explode(F.sequence("at", F.col("at") + size - 1)).alias("offset"))
    around = F.explode(F.sequence(F.lit(-slop), F.lit(slop))).alias("away")
    asked = asked.select(*whole, "offset", F.get("w", F.col("offset")).alias("term"), around).withColumn("pos", F.col("line") + F.col("offset") + F.col("away")).drop("away")
    near = found.join(met_offsets(index, asked, whole), whole).join(own, "row").where(F.size("met") >= NEAR_SHARE * size)
    return exact, near.select(*DOC, "row", F.greatest(F.col("line") + F.col("at") - slop, F.lit(0)).alias("start"), (size + 2 * slop).alias("length"))


def matches(docs: DataFrame, items: DataFrame, width: int = 10, rarest: int = 2, slop: int = 2, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(k1, k2, item, kind, start, length) of every match; kind is exact or near; k1, k2: the document's value key."""
    own, listed = item_words(items, item_col, item_text_col)
    return _matches(document_index(docs, own, id_col, text_col), own, listed, width, rarest, slop)


def _matches(index: DataFrame, own: DataFrame, listed: DataFrame, width: int, rarest: int, slop: int) -> DataFrame:
    exact, near = lookup(index, own, width, rarest, slop)
    named = lambda df, kind: df.join(listed, "row").select(*DOC, "item", F.lit(kind).alias("kind"), "start", "length")
    exact = named(exact, "exact")
    if near is None:
        return exact
    return exact.unionByName(named(near, "near").join(exact.select(*DOC, "item").distinct(), [*DOC, "item"], "left_anti"))


def contamination(docs: DataFrame, items: DataFrame, width: int = 10, rarest: int = 2, slop: int = 2, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, n_words, n_hit, items, near_items) for every row: words, words inside exact matches, ids of matching items."""
    own, listed = item_words(items, item_col, item_text_col)
    index = document_index(docs, own, id_col, text_col)
    found = _matches(index, own, listed, width, rarest, slop)
    is_exact = F.col("kind") == "exact"
    found = found.groupBy(*DOC).agg(
        F.collect_set(F.when(is_exact, F.struct("start", "length"))).alias("hits"),
        F.collect_set(F.when(is_exact, F.col("item"))).alias("items"),
        F.collect_set(F.when(~is_exact, F.col("item"))).alias("near_items"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["length"] - 1)))))
    found = found.select(*DOC, covered.cast("long").alias("n_hit"), "items", "near_items")
    lengths = index.where("term = ''").groupBy(*DOC).agg(F.max("pos").cast("long").alias("n_words"))
    kind = items.schema[item_col].dataType.simpleString()
    none = F.array().cast(f"array<{kind}>")
    out = docs.select(*value_key(id_col, text_col), F.col(id_col).alias("id")).join(lengths, DOC).join(small(written(found, "contaminated")), DOC, "left")
    return out.select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"), F.coalesce("near_items", none).alias("near_items"))


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = 10, rarest: int = 2, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of docs without an exact match."""
    names = docs.columns
    own, _ = item_words(items, item_col, item_text_col)
    exact, _ = lookup(document_index(docs, own, id_col, text_col), own, width, rarest, 0)
    found = small(written(exact.select(*DOC).distinct(), "contaminated"))
    rows = docs.select(*value_key(id_col, text_col), F.struct(*[docs[c] for c in names]).alias("row"))
    kept = rows.join(found, DOC, "left_anti")
    return kept.select(*[F.col("row")[c].alias(c) for c in names])
