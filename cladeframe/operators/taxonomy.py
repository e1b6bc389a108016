"""Taxonomy: merged ids, lineages, names, nearest references.

Lineages come from parent links, or from a stored ancestor list; both give the long table (taxid, depth, anc, rank, name),
depth 0 being the taxon itself. Links are followed by pointer doubling: each round joins the table of pointers with itself,
so n hops take log2(n) rounds, however long chains are, and what is still under way after more hops than there are links
goes round in a circle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.operators.store import stored


def follow(links: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(at, end, hops, circular) of links (at, next), each `at` once: where the links from each `at` end, and whether they
    never do; and for k = 0, 1, ... the table (at, to) of the jumps over 2^k links."""
    most = links.count()
    at = links.select("at", F.col("next").alias("to"), F.lit(1).cast("long").alias("hops"))
    way, jumps, k = stored(at, "links"), [], 0
    while True:
        jumps.append(way.where(F.col("hops") == 1 << k).select("at", "to"))
        onward = way.select(F.col("at").alias("to"), F.col("to").alias("far"), F.col("hops").alias("more"))
        both = stored(way.join(onward, "to", "left").select("at", F.coalesce("far", "to").alias("to"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"), F.col("far").isNotNull().alias("moved")), "links")
        if 1 << k > most or both.where("moved").isEmpty():
            return both.select("at", F.col("to").alias("end"), "hops", F.col("moved").alias("circular")), jumps
        way, k = both.drop("moved"), k + 1


def resolve_merged(ids: DataFrame, merged: DataFrame, nodes: DataFrame) -> DataFrame:
    """(taxid, resolved_taxid, reason): redirects followed to their end; without one the id is null and the reason is
    cycle (the redirects never end) or unknown (the end is no node). Of several redirects of one id the smallest holds."""
    ends, _ = follow(merged.groupBy(F.col("taxid_old").alias("at")).agg(F.min("taxid_new").alias("next")))
    own = ids.select("taxid").distinct().join(ends.withColumnRenamed("at", "taxid"), "taxid", "left").withColumn("to", F.coalesce("end", "taxid"))
    known = nodes.select(F.col("taxid").alias("to")).distinct().withColumn("known", F.lit(True))
    reason = F.when(F.col("circular"), "cycle").when(F.col("known").isNull(), "unknown")
    out = own.join(known, "to", "left").withColumn("reason", reason)
    return out.select("taxid", F.when(F.col("reason").isNull(), F.col("to")).alias("resolved_taxid"), "reason")


def _parents(nodes: DataFrame, root: int) -> DataFrame:
    return nodes.where((F.col("taxid") != F.col("parent")) & (F.col("taxid") != root)).groupBy(F.col("taxid").alias("at")).agg(F.min("parent").alias("next"))


def _ended(nodes: DataFrame, ids: DataFrame, ends: DataFrame) -> DataFrame:
    """(taxid, problem): null if the taxon's parents lead to a root."""
    known = nodes.select(F.col("taxid").alias("end")).distinct().withColumn("known", F.lit(True))
    own = ids.select("taxid").distinct().join(ends.withColumnRenamed("at", "taxid"), "taxid", "left").withColumn("end", F.coalesce("end", "taxid")).join(known, "end", "left")
    problem = F.when(F.col("circular"), "cycle").when(F.col("known").isNull(), F.when(F.col("hops").isNull(), "unknown").otherwise("incomplete"))
    return own.select("taxid", problem.alias("problem"))


def lineage_problems(nodes: DataFrame, ids: DataFrame, root: int = 1) -> DataFrame:
    """(taxid, problem) of the ids without a whole lineage: unknown (no node), incomplete (a parent is no node), cycle."""
    return _ended(nodes, ids, follow(_parents(nodes, root))[0]).where("problem is not null")


def lineages(nodes: DataFrame, ids: DataFrame, root: int = 1, strict: bool = True) -> DataFrame:
    """(taxid, depth, anc, rank, name) for the ids, from nodes(taxid, parent, rank, name), up to the root, which is its own
    parent or has the number `root`. Incomplete and circular lineages are an error, or left out if not strict (lineage_problems
    names them); unknown ids have no rows. Ancestors 2^k steps up are joined once for all depths below 2^k."""
    ends, jumps = follow(_parents(nodes, root))
    state = stored(_ended(nodes, ids, ends), "lineage-ends")
    if strict and (bad := state.where("problem in ('incomplete', 'cycle')").limit(5).collect()):
        raise ValueError("no whole lineage: " + ", ".join(f"{r.taxid} ({r.problem})" for r in bad))
    out = state.where("problem is null").select("taxid", F.lit(0).alias("depth"), F.col("taxid").alias("anc"))
    for k, jump in enumerate(jumps):
        far = out.join(jump.withColumnRenamed("at", "anc"), "anc").select("taxid", (F.col("depth") + (1 << k)).alias("depth"), F.col("to").alias("anc"))
        out = stored(out.union(far), "lineages")
    return out.join(nodes.select(F.col("taxid").alias("anc"), "rank", "name"), "anc").select("taxid", "depth", "anc", "rank", "name")


def lineages_from_track(nodes: DataFrame, ids: DataFrame, track: str = "track") -> DataFrame:
    """As lineages, from the comma list of ancestors, the taxon first: one explode and one join, for many ids."""
    own = nodes.join(ids.select("taxid").distinct(), "taxid", "left_semi")
    steps = own.select("taxid", F.posexplode(F.split(track, ",")).alias("depth", "anc")).withColumn("anc", F.col("anc").cast("long"))
    return steps.join(nodes.select(F.col("taxid").alias("anc"), "rank", "name"), "anc").select("taxid", "depth", "anc", "rank", "name")


def ranks(lineage: DataFrame, wanted: list[str]) -> DataFrame:
    """(taxid, <rank>, <rank>_taxid ...): for each wanted rank the nearest ancestor that has it."""
    near = lambda r, c: F.min_by(F.when(F.col("rank") == r, F.col(c)), F.when(F.col("rank") == r, F.col("depth")))
    return lineage.groupBy("taxid").agg(*[x for r in wanted for x in (near(r, "name").alias(r), near(r, "anc").alias(f"{r}_taxid"))])


def add_ranks(df: DataFrame, rank_table: DataFrame, taxid: str = "taxid") -> DataFrame:
    """Left join of one rank row per taxid."""
    return df.join(rank_table.withColumnRenamed("taxid", "__t"), F.col(taxid) == F.col("__t"), "left").drop("__t")


def common_ancestor(lineage: DataFrame, groups: DataFrame, group: str = "grp") -> DataFrame:
    """(group, anc): lowest node above or at all taxa of each group(grp, taxid). Every node lies at one depth below the
    root, so the lowest is the one with the longest way up."""
    own = groups.select(group, "taxid").distinct()
    size = own.groupBy(group).agg(F.count("*").alias("n"))
    height = lineage.groupBy("taxid").agg(F.max("depth").alias("height"))
    met = own.join(lineage, "taxid").join(height, "taxid").groupBy(group, "anc").agg(F.count("*").alias("m"), F.max(F.col("height") - F.col("depth")).alias("level"))
    return met.join(size, group).where("m = n").groupBy(group).agg(F.max_by("anc", "level").alias("anc"))


def resolve_names(queries: DataFrame, names: DataFrame, lineage: DataFrame, below: int, order: tuple[str, ...] = ("species", "genus", "family")) -> DataFrame:
    """(query, taxid, by): queries(query, species, genus, family) by the first of the ranks that has candidates, without
    regard to case, among names(taxid, name, rank; synonyms are more rows) below a clade; several give their lowest common
    ancestor."""
    under = lineage.where(F.col("anc") == below).select("taxid").distinct()
    own = names.join(under, "taxid", "left_semi").select("taxid", F.lower("name").alias("low"), "rank")
    asked = queries.select("query", F.posexplode(F.array(*[F.struct(F.lit(r).alias("rank"), F.lower(r).alias("low")) for r in order])).alias("priority", "x"))
    found = asked.select("query", "priority", "x.rank", "x.low").join(own, ["rank", "low"])
    first = found.groupBy("query").agg(F.min("priority").alias("priority"))
    best = found.join(first, ["query", "priority"]).select(F.col("query").alias("grp"), "taxid", "rank").distinct()
    lca = common_ancestor(lineage, best)
    by = best.groupBy("grp").agg(F.min("rank").alias("by"))
    return lca.join(by, "grp").select(F.col("grp").alias("query"), F.col("anc").alias("taxid"), "by")


def nearest_reference_rank(lineage: DataFrame, references: DataFrame, order: list[str]) -> DataFrame:
    """(taxid, rank): first rank of the order whose ancestor has a reference of another taxon than the taxon itself."""
    place = F.create_map(*[F.lit(x) for i, r in enumerate(order) for x in (r, i)])
    refs = lineage.join(references.select("taxid").distinct(), "taxid").select(F.col("taxid").alias("ref"), "anc")
    mine = lineage.where(F.col("rank").isin(order)).select("taxid", "anc", "rank")
    per_anc = refs.groupBy("anc").agg(F.count_distinct("ref").alias("refs"))
    self = refs.select(F.col("ref").alias("taxid"), "anc").distinct().withColumn("own", F.lit(1))
    usable = mine.join(per_anc, "anc").join(self, ["taxid", "anc"], "left").where(F.col("refs") > F.coalesce("own", F.lit(0)))
    return usable.groupBy("taxid").agg(F.min_by("rank", F.element_at(place, F.col("rank"))).alias("rank"))


def guide_edges(lineage: DataFrame) -> DataFrame:
    """(child, parent) of the tree over the given taxa, without nodes that have one child: a node stays if it is a taxon
    of the list or more taxa lie below it than below any of its children."""
    below = lineage.groupBy("anc").agg(F.count_distinct("taxid").alias("n"))
    own = lineage.select("taxid").distinct()
    chain = lineage.join(below, "anc")
    # along each taxon's way up, the last node of each count is the lowest with that set of taxa
    low = chain.groupBy("taxid", "n").agg(F.min_by("anc", "depth").alias("node"), F.min("depth").alias("depth"))
    tips = own.select("taxid", F.col("taxid").alias("node"))
    kept = low.where(F.col("n") > 1).select("taxid", "node", "depth").unionByName(tips.withColumn("depth", F.lit(-1)))
    up = F.lead("node").over(Window.partitionBy("taxid").orderBy("depth"))
    return kept.withColumn("parent", up).where("parent is not null and parent <> node").select(F.col("node").alias("child"), "parent").distinct()

