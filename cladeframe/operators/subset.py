"""Consistent subsets of a whole result set."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cladeframe.operators import forest as trees
from cladeframe.operators.expression import before_after
from cladeframe.operators.store import new_path

#: How a table is cut: by its sample column, as long feature table, as forest, or not at all.
RULES = ("sample", "alignment", "forest", "whole")


@dataclass(frozen=True)
class Table:
    """A table of a result set, its rule, and the columns the rule needs."""

    df: DataFrame
    rule: str = "sample"
    sample: str = "sample"
    group: str = "marker"


def subset(tables: dict[str, Table], keep: DataFrame, sample: str = "sample") -> dict[str, DataFrame]:
    """Every table cut to the samples of keep: rows by semi-join, values and column axes unchanged; alignments lose
    rows, never columns; trees are pruned; tables of labels stay whole even if their donor leaves."""
    own = keep.select(F.col(sample)).distinct()
    out = {}
    for name, t in tables.items():
        if t.rule not in RULES:
            raise ValueError(f"rule must be one of {RULES}")
        if t.rule == "whole":
            out[name] = t.df
        elif t.rule == "forest":
            out[name] = trees.pruned(t.df, own.select(F.col(sample).alias("tip")))
        else:
            out[name] = t.df.join(own.withColumnRenamed(sample, t.sample), t.sample, "left_semi")
    return out


def dropped_groups(before: DataFrame, after: DataFrame, group: str) -> DataFrame:
    """Groups of an alignment table that the subset leaves empty."""
    return before.select(group).distinct().join(after.select(group).distinct(), group, "left_anti")


@dataclass(frozen=True)
class Node:
    """A table of a result set and how it follows from others.

    rule "keep": the rows whose key the keep list names (the samples); every other table hangs on it in the end.
    rule "rows": the rows whose `key` is a `parent_key` of the parent as it was cut (runs, long and wide expression, quality,
    gene tables): columns and values stay. unique: a key occurs once; complete: every key of the parent's source occurs.
    rule "groups": as rows, for alignments: rows go and columns stay; groups (column `group`) left without a row are listed.
    rule "forest": trees of the node table, cut to the tips that are keys of the parent; `group` is the tree.
    rule "pairs": contrast pairs of the parent forest, found again on the trees as they were cut, with the traits of table
    `traits` (columns tip, trait) as it was cut. df is the old table of pairs, whose ids are never inherited.
    rule "whole": labels and feature tables, which stay even if a donor leaves.
    """

    df: DataFrame
    rule: str = "rows"
    key: str = "sample"
    parent: str | None = None
    parent_key: str = "sample"
    group: str | None = None
    traits: str | None = None
    unique: bool = False
    complete: bool = False


GRAPH_RULES = ("keep", "rows", "groups", "forest", "pairs", "whole")


def evaluation_order(graph: dict[str, Node]) -> list[str]:
    """Names so that every table follows those it hangs on."""
    for name, node in graph.items():
        if node.rule not in GRAPH_RULES:
            raise ValueError(f"{name}: rule must be one of {GRAPH_RULES}")
        if (node.rule not in ("keep", "whole")) != (node.parent is not None):
            raise ValueError(f"{name}: a table that follows another, and only such a table, has a parent")
        for other in (node.parent, node.traits):
            if other is not None and other not in graph:
                raise ValueError(f"{name}: no table {other}")
    out: list[str] = []
    while len(out) < len(graph):
        ready = [n for n, x in graph.items() if n not in out and all(o is None or o in out for o in (x.parent, x.traits))]
        if not ready:
            raise ValueError(f"tables hang on each other in a circle: {sorted(set(graph) - set(out))}")
        out += ready
    return out


def _keys(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.select(F.col(column).alias(name)).where(F.col(name).isNotNull()).distinct()


def cut_graph(graph: dict[str, Node], keep: DataFrame, sample: str = "sample") -> dict[str, DataFrame]:
    """Every table cut, each by its rule, after those it hangs on."""
    cut: dict[str, DataFrame] = {}
    for name in evaluation_order(graph):
        node = graph[name]
        if node.rule == "keep":
            cut[name] = node.df.join(_keys(keep, sample, node.key), node.key, "left_semi").select(*node.df.columns)
        elif node.rule in ("rows", "groups"):
            cut[name] = node.df.join(_keys(cut[node.parent], node.parent_key, node.key), node.key, "left_semi").select(*node.df.columns)
        elif node.rule == "forest":
            cut[name] = trees.pruned(node.df, _keys(cut[node.parent], node.parent_key, "tip"))
        elif node.rule == "pairs":
            cut[name] = trees.contrast_pairs(cut[node.parent], cut[node.traits].select("tip", "trait"))
        else:
            cut[name] = node.df
    return cut


def graph_problems(graph: dict[str, Node], keep: DataFrame, sample: str = "sample") -> DataFrame:
    """(table, problem, key): what makes the source unfit for a subset, before anything is cut: keys to keep that no table of
    samples has, keys without a parent (orphans), keys that occur twice where they must not, parents without a row where a
    table must be complete."""
    found = []
    say = lambda name, problem, df, c: found.append(df.select(F.lit(name).alias("table"), F.lit(problem).alias("problem"), F.col(c).cast("string").alias("key")))
    for name in evaluation_order(graph):
        node = graph[name]
        if node.rule == "keep":
            say(name, "unknown", _keys(keep, sample, node.key).join(node.df.select(node.key), node.key, "left_anti"), node.key)
        if node.rule in ("rows", "groups"):
            have, want = _keys(node.df, node.key, "k"), _keys(graph[node.parent].df, node.parent_key, "k")
            say(name, "orphan", have.join(want, "k", "left_anti"), "k")
            if node.complete:
                say(name, "missing", want.join(have, "k", "left_anti"), "k")
        if node.rule == "forest":
            tips = trees.tips(node.df).select(F.col("name").alias("k")).distinct()
            say(name, "orphan", tips.join(_keys(graph[node.parent].df, node.parent_key, "k"), "k", "left_anti"), "k")
        if node.unique:
            say(name, "repeated", node.df.groupBy(node.key).count().where("count > 1"), node.key)
    return reduce(DataFrame.union, found)


def dropped_in_graph(graph: dict[str, Node], cut: dict[str, DataFrame]) -> DataFrame:
    """(table, group): groups of alignments that lost every row, and trees that kept fewer than two tips."""
    parts = []
    for name, node in graph.items():
        if node.rule in ("groups", "forest"):
            group = node.group or "tree_id"
            gone = node.df.select(F.col(group).alias("group")).distinct().join(cut[name].select(F.col(group).alias("group")).distinct(), "group", "left_anti")
            parts.append(gone.select(F.lit(name).alias("table"), F.col("group").cast("string").alias("group")))
    return reduce(DataFrame.union, parts)


def write_graph(graph: dict[str, Node], keep: DataFrame, sample: str = "sample", folder: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables cut and written below folder, and (table, rule, rows_before, rows_after, orphans).

    Rows are counted by the pass that writes a table: observed where the source is read and where the result is written, so
    a table that is cut by rows is scanned once. Trees and pairs, which are read several times, are written from their
    stored sources and counted apart. orphans: keys of the written table that its written parent lacks."""
    spark, cut, report = keep.sparkSession, {}, []
    folder = folder or new_path(spark, "subset")
    for name in evaluation_order(graph):
        node = graph[name]
        before, after = Observation(), Observation()
        if node.rule in ("forest", "pairs"):
            rows_before, source = node.df.count(), node.df
        else:
            rows_before, source = None, node.df.observe(before, F.count(F.lit(1)).alias("n"))
        if node.rule == "keep":
            out = source.join(_keys(keep, sample, node.key), node.key, "left_semi").select(*node.df.columns)
        elif node.rule in ("rows", "groups"):
            out = source.join(_keys(cut[node.parent], node.parent_key, node.key), node.key, "left_semi").select(*node.df.columns)
        elif node.rule == "forest":
            out = trees.pruned(source, _keys(cut[node.parent], node.parent_key, "tip"))
        elif node.rule == "pairs":
            out = trees.contrast_pairs(cut[node.parent], cut[node.traits].select("tip", "trait"))
        else:
            out = source
        path = f"{folder}/{name}"
        out.observe(after, F.count(F.lit(1)).alias("n")).write.parquet(path)
        cut[name] = spark.read.schema(out.schema).parquet(path)
        orphans = None
        if node.rule in ("rows", "groups", "forest"):
            own = _keys(cut[name], node.key, "k") if node.rule != "forest" else trees.tips(cut[name]).select(F.col("name").alias("k")).distinct()
            orphans = own.join(_keys(cut[node.parent], node.parent_key, "k"), "k", "left_anti")
        elif node.rule == "pairs":
            orphans = cut[name].select("tree_id", "node_id").join(cut[node.parent].select("tree_id", "node_id"), ["tree_id", "node_id"], "left_anti")
        lost = orphans.count() if orphans is not None else 0
        report.append((name, node.rule, rows_before if rows_before is not None else before.get["n"], after.get["n"], lost))
    return cut, spark.createDataFrame(report, "`table` string, rule string, rows_before long, rows_after long, orphans long")


def subset_counts(tables: dict[str, Table], after: dict[str, DataFrame]) -> DataFrame:
    return before_after({k: t.df for k, t in tables.items()}, after)


def without_flagged(tables: dict[str, DataFrame], flagged: DataFrame, key: str = "run") -> dict[str, DataFrame]:
    """Every table without the flagged keys."""
    own = flagged.select(key).distinct()
    return {name: df.join(own, key, "left_anti") for name, df in tables.items()}


def attach_pairs(base: DataFrame, branch: DataFrame, key: str = "species", trait: str = "trait", label: str = "", columns: tuple[str, ...] = ("contrast_pair_id", "phylogenetic_block_id")) -> DataFrame:
    """base with the pair and block ids of a branch; ids of an earlier run are wiped, never inherited. conflict: the
    traits of the two tables differ, or a block isn't its anchor pair's."""
    names = [c for c in columns if c in branch.columns]
    clean = base.drop(*[f"{c}{label}" for c in columns])
    own = branch.select(key, F.col(trait).alias("__trait"), *[F.col(c).alias(f"{c}{label}") for c in names])
    out = clean.join(own, key, "left")
    clash = F.col("__trait").isNotNull() & ~F.col("__trait").eqNullSafe(F.col(trait))
    if len(names) == 2:
        pair, block = (F.col(f"{c}{label}") for c in names)
        clash = clash | (pair.isNotNull() & block.isNotNull() & (pair != block))
    return out.withColumn(f"conflict{label}", F.coalesce(clash, F.lit(False))).drop("__trait")


def attach_branches(base: DataFrame, branches: dict[str, DataFrame], key: str = "species", trait: str = "trait") -> DataFrame:
    """As attach_pairs for each branch; columns carry the branch's name only if there are several."""
    out = base.drop("contrast_pair_id", "phylogenetic_block_id")
    for name, branch in branches.items():
        out = attach_pairs(out, branch, key, trait, f"_{name}" if len(branches) > 1 else "")
    return out


def processing_summary(runs: DataFrame, sample: str = "sample", single: str = "single", duplicated: str = "duplicated", total: str = "total", clade: str = "clade", labels: dict[str, str] | None = None) -> DataFrame:
    """One row per sample with completeness in percent, two decimals, and the clade's label."""
    share = (F.col(single) + F.col(duplicated)).cast("decimal(20,4)") * 100 / F.col(total)
    names = F.create_map(*[F.lit(x) for pair in (labels or {"": ""}).items() for x in pair])
    return runs.withColumn("completeness_percent", F.format_number(share, 2)).withColumn("clade_label", F.coalesce(F.try_element_at(names, F.col(clade)), F.col(clade)))
