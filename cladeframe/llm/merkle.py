"""Merkle manifest of a dataset: a tree of 16 children a node over each source's rows, and one over the sources.

Leaf coordinates come from bitmaps. Every task sets the bits of its ids in words of 64, and the words are merged by OR per
source; only words with a bit are stored. A directory gives each word the number of rows of its source before it: words
are counted within containers of 4,096 words, these within containers of 4,096, and so on up to the top. An id's place in its
source is its word's directory entry plus the bits set below it, so no source is sorted.

Leaves then go to slots: a row holds 256 neighbouring leaves, keyed by (source, place div 256), and reduces two levels at
once; the nodes above go to slots of 16 until each source has one. Paths come back down the same keys, and proofs are built
within the rows of 256 leaves, so siblings are shuffled once for 256 leaves and never for each.

Cases: any column may be null; a null source is one of its own, the first. Rows of equal source and id, null ids included
(they come first), are ordered by their leaf, found by a second bitmap over its first 60 bits; those bits are the whole
order (rows that differ, but not in them, are not expected). Repeated rows have equal leaves and take
neighbouring slots. Very long texts are hashed whole. A source with one row is its own subroot, and one source's subroot
is the root. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.store import numbered
from .common import ascii_lower, bind, small, written

FANOUT, BLOCK = 16, 256
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Bits of a word's number that a container of the directory spans.
SPAN = 12
PATH = "array<struct<left:string,right:string>>"


class Manifest(NamedTuple):
    """blocks: (source, block, n, ids, leaves, changed, runs), 256 leaves a row, runs their parents; paths: (source, block,
    subroot, path), the siblings above a block; subroots: (source, subroot, n); root: None for an empty table."""

    blocks: DataFrame
    paths: DataFrame
    subroots: DataFrame
    root: str | None


def leaf_hash(columns: Sequence[Column]) -> Column:
    """SHA-256 over the columns, `-` for a null, else the number of bytes, a colon and the value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def node_hash(children: Column) -> Column:
    return F.sha2(F.array_join(children, ""), 256)


def rank_directory(keys: DataFrame) -> DataFrame:
    """(source, word, bits, base, repeats) of distinct (source, key, n): base: n of the source's keys in words before; repeats: (low,
    n - 1) of the word's keys whose n is not 1."""
    low = F.col("key").bitwiseAND(63).cast("int")
    more = F.collect_list(F.when(F.col("n") > 1, F.struct(low.alias("low"), (F.col("n") - 1).alias("more"))))
    words = keys.groupBy("source", F.shiftright("key", 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), low)).alias("bits"), F.sum("n").alias("n"), more.alias("repeats"))
    words = written(words, "merkle-words")
    first, last = words.agg(F.min("word"), F.max("word")).first()
    counts, up = [words.select("source", F.col("word").alias("node"), "n")], 0
    while first is not None and (last >> up) - (first >> up) >= 1 << SPAN:
        counts.append(counts[-1].groupBy("source", F.shiftright("node", SPAN).alias("node")).agg(F.sum("n").alias("n")))
        up += SPAN
    base = None
    for level in reversed(counts):
        before = lambda by: F.coalesce(F.sum("n").over(by.orderBy("node").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        if base is None:
            base = level.select("source", "node", before(Window.partitionBy("source")).alias("base"))
            continue
        inside = level.withColumn("parent", F.shiftright("node", SPAN)).withColumn("inside", before(Window.partitionBy("source", "parent")))
        above = base.select("source", F.col("node").alias("parent"), "base")
        base = inside.join(above, ["source", "parent"]).select("source", "node", (F.col("base") + F.col("inside")).alias("base"))
    return words.join(base.withColumnRenamed("node", "word"), ["source", "word"]).select("source", "word", "bits", "base", "repeats")


def ranked(rows: DataFrame, directory: DataFrame) -> DataFrame:
    """rows (source, key, ...) with the place of the first row of their key, and `tied`, the other rows of it."""
    low = F.col("key").bitwiseAND(63).cast("int")
    below = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), low))))
    more = F.aggregate(F.filter("repeats", lambda r: r["low"] < low), F.lit(0).cast("long"), lambda n, r: n + r["more"])
    tied = F.aggregate(F.filter("repeats", lambda r: r["low"] == low), F.lit(0).cast("long"), lambda n, r: n + r["more"])
    own = rows.withColumn("word", F.shiftright("key", 6)).join(directory, ["source", "word"])
    return own.withColumn("place", F.col("base") + below + more).withColumn("tied", tied).drop("word", "bits", "base", "repeats")


def _placed(leaves: DataFrame) -> DataFrame:
    """(source, id, leaf, changed, place) of leaves (source, id, leaf, changed): a row for each slot."""
    keyed = leaves.where(F.col("id").isNotNull()).withColumn("key", F.col("id").cast("long"))
    counts = keyed.groupBy("source", "key").agg(F.count("*").alias("n"))
    first = ranked(keyed, small(written(rank_directory(counts), "merkle-directory")))
    none = leaves.where(F.col("id").isNull())
    nulls = none.groupBy("source").agg(F.count("*").alias("nulls"))
    have_nulls = not nulls.isEmpty()
    if have_nulls:
        nulls = small(written(nulls, "merkle-nulls"))
        first = first.join(nulls, "source", "left").withColumn("place", F.col("place") + F.coalesce("nulls", F.lit(0))).drop("nulls")
        of_none = none.join(nulls, "source").withColumn("place", F.lit(0).cast("long")).withColumn("tied", F.col("nulls") - 1)
        first = first.drop("key").unionByName(of_none.drop("nulls"))
    first = written(first.select("source", "id", "leaf", "changed", "place", "tied"), "merkle-places")
    ties = first.where("tied > 0")
    if ties.isEmpty():
        return first.drop("tied")
    # equal ids: the leaf's first bits decide, and equal leaves take one slot after the other
    group = F.concat("of", F.lit("/"), F.coalesce(F.col("id").cast("string"), F.lit("-")))
    key = F.conv(F.substring(F.hex("leaf"), 1, 15), 16, 10).cast("long")
    ties = ties.withColumnRenamed("source", "of").withColumnRenamed("place", "begin").withColumn("source", group).withColumn("key", key).drop("tied")
    counts = ties.groupBy("source", "key").agg(F.count("*").alias("n"))
    same = ties.groupBy("source", "key", "of", "id", "begin", "leaf", "changed").agg(F.count("*").alias("n"))
    inside = ranked(same, written(rank_directory(counts), "merkle-directory"))
    each = inside.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    each = each.select(F.col("of").alias("source"), "id", "leaf", "changed", (F.col("begin") + F.col("place") + F.col("k")).alias("place"))
    return first.where("tied = 0").drop("tied").unionByName(each)


def _climb(nodes: DataFrame, name: str) -> tuple[DataFrame, list[DataFrame]]:
    """The last node of each source, (source, hash), and the levels (source, run, count, hashes) on the way up. nodes: (source, node,
    hash, count), count those of the source on this level."""
    levels = []
    while True:
        most = nodes.agg(F.max("count")).first()[0]
        if most is None or most == 1:
            return nodes.select("source", "hash"), levels
        slots = F.array_sort(F.collect_list(F.struct(F.pmod("node", F.lit(FANOUT)).alias("slot"), "hash")))
        runs = nodes.groupBy("source", F.floor(F.col("node") / FANOUT).alias("run"), "count").agg(slots.alias("slots"))
        runs = written(runs.select("source", "run", "count", F.col("slots.hash").alias("hashes")), f"merkle-{name}")
        levels.append(runs)
        up = F.when(F.col("count") > 1, node_hash(F.col("hashes"))).otherwise(F.get("hashes", F.lit(0)))
        nodes = runs.select("source", F.col("run").alias("node"), up.alias("hash"), F.ceil(F.col("count") / FANOUT).alias("count"))


def _siblings(hashes: Column, i: Column) -> Column:
    """What stands left and right of the i-th in its run."""
    at = F.pmod(i, F.lit(FANOUT))
    return F.struct(F.array_join(F.slice(hashes, i - at + 1, at), "").alias("left"), F.array_join(F.slice(hashes, i + 2, FANOUT - 1 - at), "").alias("right"))


def _descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(source, node, ..., path) of the nodes below levels. tops: (source, ..., path), the paths of the sources' last nodes."""
    carried = [c for c in tops.columns if c not in ("source", "path")]
    paths = tops.withColumn("node", F.lit(0).cast("long"))
    for runs in reversed(levels):
        above = paths.withColumnRenamed("node", "run").withColumnRenamed("path", "above")
        own = F.when(F.col("count") > 1, F.array(_siblings(F.col("hashes"), F.col("at")))).otherwise(F.array().cast(PATH))
        each = runs.join(above, ["source", "run"]).select("*", F.posexplode("hashes").alias("at", "hash"))
        paths = each.select("source", *carried, (F.col("run") * FANOUT + F.col("at")).alias("node"), F.concat(own, F.col("above")).alias("path"))
    return paths


def manifest(docs: DataFrame, changed: Sequence[Column] | None = None, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", source_col: str = "source") -> Manifest:
    """The tree over the rows of docs. changed: other values of the columns, whose leaves are kept beside the true ones, null where they are the same."""
    leaf, other = leaf_hash([docs[c] for c in columns]), leaf_hash(list(changed)) if changed else F.lit(None).cast("string")
    source = F.when(docs[source_col].isNull(), "").otherwise(F.concat(F.lit("="), docs[source_col].cast("string")))  # no nulls to join on, and in order
    leaves = docs.select(source.alias("source"), docs[id_col].alias("id"), leaf.alias("leaf"), other.alias("changed"))
    leaves = leaves.select("source", "id", F.unhex("leaf").alias("leaf"), F.unhex(F.when(F.col("changed") != F.col("leaf"), F.col("changed"))).alias("changed"))
    placed = _placed(written(leaves, "merkle-leaves"))
    hexed = lambda c: F.lower(F.hex(c))
    slots = F.array_sort(F.collect_list(F.struct(F.pmod("place", F.lit(BLOCK)).alias("slot"), "id", "leaf", "changed")))
    blocks = placed.groupBy("source", F.floor(F.col("place") / BLOCK).alias("block")).agg(slots.alias("s"))
    blocks = blocks.select("source", "block", F.col("s.id").alias("ids"), F.transform("s", lambda s: hexed(s["leaf"])).alias("leaves"), F.transform("s", lambda s: hexed(s["changed"])).alias("changed"))
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size("leaves") - 1) / FANOUT).cast("int")), lambda k: node_hash(F.slice("leaves", k * FANOUT + 1, FANOUT)))
    blocks = written(blocks.withColumn("runs", runs), "merkle-blocks")
    sizes = small(written(blocks.groupBy("source").agg(F.sum(F.size("leaves")).alias("n")), "merkle-sizes"))
    blocks = blocks.join(sizes, "source")
    top = F.when(F.col("n") == 1, F.get("leaves", F.lit(0))).when(F.col("n") <= FANOUT, F.get("runs", F.lit(0))).otherwise(node_hash(F.col("runs")))
    own, levels = _climb(blocks.select("source", F.col("block").alias("node"), top.alias("hash"), F.ceil(F.col("n") / BLOCK).alias("count")), "nodes")
    subroots = written(own.join(sizes, "source").select("source", F.col("hash").alias("subroot"), "n"), "merkle-subroots")
    listed = written(numbered(subroots.select("source", "subroot"), [F.col("source")]), "merkle-sources")
    total = listed.count()
    last, above = _climb(listed.select(F.lit("").alias("source"), F.col("place").alias("node"), F.col("subroot").alias("hash"), F.lit(total).alias("count")), "sources")
    top_paths = _descend(above, last.select("source", F.array().cast(PATH).alias("path")))
    tops = top_paths.select(F.col("node").alias("place"), "path").join(listed, "place").select("source", "subroot", "path")
    paths = _descend(levels, tops).withColumnRenamed("node", "block")
    root = last.first()
    return Manifest(blocks, paths, subroots, root["hash"] if root else None)


def proofs(tree: Manifest) -> DataFrame:
    """(id, leaf, subroot, root, proof, folded_root): for each row a hash of its siblings up to the root, left to right and level by level, and
    the root that they give with the changed leaf, or with the true one where none was changed."""
    rows = tree.blocks.join(small(written(tree.paths, "merkle-paths")), ["source", "block"])

    def one(leaf: Column, i: Column) -> Column:
        none = F.array().cast(PATH)
        first = F.when(F.col("n") > 1, F.array(_siblings(F.col("leaves"), i))).otherwise(none)
        second = F.when(F.col("n") > FANOUT, F.array(_siblings(F.col("runs"), F.floor(i / FANOUT).cast("int")))).otherwise(none)

        def read(path: Column) -> Column:
            beside = F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")
            folded = F.aggregate(path, F.coalesce(F.get("changed", i), leaf), lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))
            return F.struct(F.get("ids", i).alias("id"), leaf.alias("leaf"), F.sha2(beside, 256).alias("proof"), folded.alias("folded_root"))

        return bind(F.concat(first, second, F.col("path")), read)

    each = rows.select("subroot", F.explode(F.transform("leaves", one)).alias("x"))
    return each.select("x.id", "x.leaf", "subroot", F.lit(tree.root).alias("root"), "x.proof", "x.folded_root")


def tampered(docs: DataFrame, every: int = 5, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """The columns, the text lower-cased (A-Z) in rows whose id's checksum `every` divides."""
    hit = F.crc32(docs[id_col].cast("string").cast("binary")) % every == 0
    return [F.when(hit, ascii_lower(docs[c])).otherwise(docs[c]) if c == text_col else docs[c] for c in columns]
