"""Line dedup over overlapping three-line windows.

The lines of a document that hold a word, trimmed, are hashed in windows of `width` consecutive ones. A window found
earlier, in the order of (id, place), marks its lines; the lines that marked windows cover are removed, merged, and the
others stay unchanged. A window's first occurrence stays. Hashes have 128 bits.

Cases: lines without a word are no part of windows and stay. A null text has no lines and stays null; an empty one has
one line without a word. Very long texts are windowed whole. Documents with fewer lines than a window stay whole. Rows repeated in the table (equal id and
text) are one document to this operator and are treated alike; rows of equal id and different texts are ordered by a
hash of the row; a null id comes last. An empty table gives an empty result. Other columns are kept, whatever their
names. Native: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, bind, value_key



def zero() -> Column:
    return F.lit(0)


def _window_hashes(text: Column, width: int) -> Column:
    """array<struct<at, h1, h2>>: for each window the number of its first line among all lines, and its hash."""
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("i"), F.trim(x, F.lit(SPACES)).alias("x")))
    full = F.filter(lines, lambda s: s["x"] != "")

    def windows(own: Column) -> Column:
        def one(i: Column) -> Column:
            xs = [F.get(own, i + k)["x"] for k in range(width)]
            return F.struct(i.cast("int").alias("at"), F.xxhash64(*xs).alias("h1"), F.xxhash64(F.lit(7), *reversed(xs)).alias("h2"))

        return F.when(F.size(own) >= width, F.transform(F.sequence(zero(), F.size(own) - width), one)).otherwise(F.array().cast("array<struct<at:int,h1:bigint,h2:bigint>>"))

    return bind(full, windows)


def removed_lines(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(k1, k2, removed): for documents that lose lines, which, counted from 0 among those with a word."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = texts.select(*value_key("id", "text"), "id", "text")
    found = texts.select("k1", "k2", "id", F.explode(_window_hashes(F.col("text"), width)).alias("w")).select("k1", "k2", "id", "w.*")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2", "at")
    first = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").select("h1", "h2", "first")
    later = found.join(first, ["h1", "h2"]).where(place > F.col("first"))
    marked = later.groupBy("k1", "k2").agg(F.collect_set("at").alias("at"))
    covered = F.array_distinct(F.flatten(F.transform("at", lambda i: F.sequence(i, i + (width - 1)))))
    return marked.select("k1", "k2", F.array_sort(covered).alias("removed"))


def dedup_lines(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text", mark: str = "n_removed") -> DataFrame:
    """The columns of docs with the text that stays, and the number of lines removed in column `mark` (line_`mark` if docs
    has one of that name)."""
    names = docs.columns
    mark = f"line_{mark}" if mark in names else mark
    removed = removed_lines(docs, width, id_col, text_col)
    rows = docs.select(*value_key(id_col, text_col), F.struct(*[docs[c] for c in names]).alias("row"))
    out = rows.join(removed.hint("shuffle_hash"), ["k1", "k2"], "left")
    text = F.when(F.col("removed").isNull(), F.col("row")[text_col]).otherwise(F.array_join(_kept_lines(F.col("row")[text_col], F.col("removed")), "\n"))
    return out.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in names], F.coalesce(F.size("removed"), zero()).cast("long").alias(mark))


def _kept_lines(text: Column, removed: Column) -> Column:
    """Lines of text but those removed. Numbers among lines with a word become numbers among all lines first."""

    def keep(lines: Column) -> Column:
        numbered = F.transform(lines, lambda x, i: F.struct(i.alias("i"), (F.trim(x, F.lit(SPACES)) != "").alias("word")))
        worded = F.transform(F.filter(numbered, lambda s: s["word"]), lambda s: s["i"])

        def without(at: Column) -> Column:
            gone = F.transform(removed, lambda r: F.get(at, r))
            stays = F.array_except(F.sequence(zero(), F.size(lines) - 1), gone)
            return F.transform(stays, lambda i: F.get(lines, i))

        return bind(worded, without)

    return bind(F.split(text, "\n"), keep)
