"""Forests from Newick text: one tree per row in, one row per node out.

Files are read in pieces that end at semicolons, and a piece ends a tree only if its semicolon stands outside of quotes and
comments. Whether it does depends on all text before it, so each task says of its block of a file what state each of the
three states it may begin in (plain, quoted, comment) leads to; the few blocks of a file are put in order, and every piece
then knows its own state and the number of its tree.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.operators.store import stored

NODES = "tree_id string, node_id int, parent_id int, name string, dist double, support double, depth int, tin int, tout int, problem string"
SCHEMA = pa.schema([
    ("tree_id", pa.string()), ("node_id", pa.int32()), ("parent_id", pa.int32()), ("name", pa.string()), ("dist", pa.float64()), ("support", pa.float64()),
    ("depth", pa.int32()), ("tin", pa.int32()), ("tout", pa.int32()), ("problem", pa.string()),
])
TOKEN = re.compile(r"\s*(?:\[[^\]]*\]|('(?:[^']|'')*')|([(),:;])|([^\s(),:;\[']+))")


def nodes_of(tree_id: str, text: str) -> list[tuple]:
    """Rows of one tree: ids in order of opening, tips numbered from left to right. A
    tree that can't be read gives one row with its problem."""
    parent, name, dist, opened = [None], [""], [None], 0
    at, expect = 0, "name"
    children = [0]
    try:
        end = 0
        for m in TOKEN.finditer(text):
            quoted, mark, word = m.groups()
            if m.start() != end:
                raise ValueError("a quote or comment without an end")
            end = m.end()
            if mark == "(":
                opened += 1
                parent.append(at), name.append(""), dist.append(None), children.append(0)
                children[at] += 1
                at, expect = len(parent) - 1, "name"
            elif mark == ",":
                up = parent[at]
                parent.append(up), name.append(""), dist.append(None), children.append(0)
                children[up] += 1
                at, expect = len(parent) - 1, "name"
            elif mark == ")":
                opened -= 1
                at, expect = parent[at], "name"
            elif mark == ":":
                expect = "dist"
            elif mark == ";":
                break
            elif quoted or word:
                value = quoted[1:-1].replace("''", "'") if quoted else word
                if expect == "name":
                    name[at], expect = value, "mark"
                elif expect == "dist":
                    dist[at], expect = float(value), "mark"
                else:
                    raise ValueError("two words in a row: names with spaces must be quoted")
        if opened or at is None or text[end:].strip():
            raise ValueError("unbalanced, or text behind the end")
    except (ValueError, TypeError, IndexError):
        return [(tree_id, 0, None, None, None, None, 0, 0, 0, "unreadable")]
    n = len(parent)
    depth = [0] * n
    tin, tout, tips = [0] * n, [-1] * n, 0
    for i in range(n):
        if i:
            depth[i] = depth[parent[i]] + 1
        if not children[i]:
            tin[i] = tout[i] = tips
            tips += 1
    first: list = [None] * n
    for i in range(n - 1, -1, -1):
        first[i] = tin[i] if not children[i] else first[i]
        if i:
            p = parent[i]
            first[p] = first[i] if first[p] is None else min(first[p], first[i])
            tout[p] = max(tout[p], tout[i])
    names = [name[i] for i in range(n) if not children[i]]
    bad = "repeated_tip" if len(set(names)) < len(names) else "bad_length" if any(d is not None and not (math.isfinite(d) and d >= 0) for d in dist) else None
    out = []
    for i in range(n):
        inner = children[i] > 0
        support = float(name[i]) if inner and re.fullmatch(r"[0-9.]+(?:[eE][+-]?[0-9]+)?", name[i]) and name[i] != "." else None
        out.append((tree_id, i, parent[i], name[i] if not (inner and support is not None) else None, dist[i], support, depth[i], first[i], tout[i], bad))
    return out


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # a batch costs far more than a row: small trees share one, large ones take several
    def packed(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(rows), 20_000):
            cols = list(zip(*rows[i : i + 20_000]))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, SCHEMA.types)], schema=SCHEMA)

    held: list[tuple] = []
    for batch in batches:
        for tree_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held += nodes_of(tree_id, text or "")
            if len(held) >= 20_000:
                yield from packed(held)
                held = []
    yield from packed(held)


def forest(trees: DataFrame, tree_id: str = "tree_id", newick: str = "newick") -> DataFrame:
    """Node table of trees(tree_id, newick); parallel over trees. problem marks all nodes of a tree that breaks a rule."""
    return trees.select(F.col(tree_id).cast("string").alias("tree_id"), F.col(newick).alias("newick")).mapInArrow(_parse, NODES)


PLAIN, QUOTED, COMMENT = range(3)
PIECES = "file string, block long, place long, piece string, after array<int>, ends array<long>"


def state_after(text: str, state: int) -> int:
    """The state behind a text that begins in one. A doubled quote leaves a quoted name and enters it again."""
    i = 0
    while i < len(text):
        if state == PLAIN:
            m = re.compile(r"['\[]").search(text, i)
            if not m:
                break
            state, i = (QUOTED if m[0] == "'" else COMMENT), m.end()
        else:
            i = text.find("'" if state == QUOTED else "]", i)
            if i < 0:
                break
            state, i = PLAIN, i + 1
    return state


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece with the state behind it and the trees ended before it, for each state that its block may begin in."""
    block, states, ends, place = None, [], [], 0
    for batch in batches:
        out: list[list] = [[] for _ in range(6)]
        for file, start, text in zip(*[c.to_pylist() for c in batch.columns]):
            if (file, start) != block:
                block, states, ends, place = (file, start), [PLAIN, QUOTED, COMMENT], [0, 0, 0], 0
            before = list(ends)
            behind = {s: state_after(text, s) for s in set(states)}
            states = [behind[s] for s in states]
            ends = [n + (s == PLAIN) for n, s in zip(ends, states)]
            for column, value in zip(out, (file, start, place, text, list(states), before)):
                column.append(value)
            place += 1
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["file", "block", "place", "piece", "after", "ends"])


def tree_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, newick): the trees of one or many files, over several lines or not, in the order of each file."""
    raw = spark.read.text(path, lineSep=";").select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    pieces = stored(raw.mapInArrow(_pieces, PIECES), "newick-pieces")
    ending = pieces.groupBy("file", "block").agg(F.max_by(F.struct("after", F.transform("after", lambda s, k: F.get("ends", k) + F.when(s == PLAIN, 1).otherwise(0)).alias("ends")), "place").alias("x"))
    # a file has a block for each piece of it that one task reads
    blocks = ending.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "x.after", "x.ends"))).alias("blocks"))
    begin = F.struct(F.lit(PLAIN).alias("state"), F.lit(0).cast("long").alias("number"))
    start = F.struct(begin.alias("now"), F.array().cast("array<struct<block:bigint,state:int,number:bigint>>").alias("out"))

    def onward(state, b):
        now = state["now"]
        row = F.struct(b["block"].alias("block"), now["state"].alias("state"), now["number"].alias("number"))
        return F.struct(F.struct(F.get(b["after"], now["state"]).alias("state"), (now["number"] + F.get(b["ends"], now["state"])).alias("number")).alias("now"), F.concat(state["out"], F.array(row)).alias("out"))

    begins = blocks.select("file", F.explode(F.aggregate("blocks", start, onward, lambda x: x["out"])).alias("b")).select("file", "b.*")
    own = pieces.join(begins, ["file", "block"]).withColumn("number", F.col("number") + F.get("ends", F.col("state")))
    trees = own.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("block", "place", "piece"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["piece"]), ";")
    trees = trees.select("file", "number", text.alias("newick")).where(F.trim(F.regexp_replace("newick", r"\s", "")) != "")
    return trees.select("file", "number", F.concat("newick", F.lit(";")).alias("newick"))


def read_forest(spark: SparkSession, path: str) -> DataFrame:
    """Trees of one or many files; a tree's id is its file's name and its number in that file, from 0."""
    name = F.regexp_extract("file", r"([^/]+?)(?:\.[A-Za-z0-9]+)*$", 1)
    # stored, as operators on forests read their nodes several times
    return stored(forest(tree_texts(spark, path).select(F.concat_ws("#", name, F.col("number").cast("string")).alias("tree_id"), "newick")), "newick-nodes")
