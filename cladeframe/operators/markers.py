"""Marker genes: completeness counts, single copies, coverage, alignments, reference panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.operators.store import numbered, stored

from cladeframe.functions.text import decimal_ceiling

STATUSES = ("Complete", "Duplicated", "Fragmented", "Missing")


def completeness_counts(full: DataFrame, sample: str = "sample", marker: str = "marker", status: str = "status") -> DataFrame:
    """(sample, single, duplicated, fragmented, missing, total, repeated): markers by status; repeated counts markers
    with several rows that aren't all Duplicated, which is an error."""
    per_marker = full.groupBy(sample, marker).agg(F.min(status).alias("s"), F.count("*").alias("n"), F.count_if(F.col(status) != "Duplicated").alias("other"))
    named = [F.count_if(F.col("s") == s).alias(name) for s, name in zip(STATUSES, ("single", "duplicated", "fragmented", "missing"))]
    return per_marker.groupBy(sample).agg(*named, F.count("*").alias("total"), F.count_if((F.col("n") > 1) & (F.col("other") > 0)).alias("repeated"))


def single_copy(full: DataFrame, sample: str = "sample", marker: str = "marker", status: str = "status", sequence: str = "sequence") -> DataFrame:
    """Complete hits of markers that have one row, without sequences that serve several markers."""
    own = full.withColumn("__n", F.count("*").over(Window.partitionBy(sample, marker))).where((F.col("__n") == 1) & (F.col(status) == "Complete"))
    return own.withColumn("__m", F.count("*").over(Window.partitionBy(sample, sequence))).where("__m = 1").drop("__n", "__m")


def marker_coverage(hits: DataFrame, markers: DataFrame, samples: DataFrame, min_taxa: str, sample: str = "sample", species: str = "species_id", marker: str = "marker", length: str = "length") -> DataFrame:
    """(marker, species, samples, occupancy, mean_length, eligible, place) for every marker of the universe; place ranks
    by occupancy, then id, among the eligible."""
    total = samples.agg(F.count_distinct(species).alias("total"))
    own = hits.join(samples.select(sample, species).distinct(), sample).groupBy(marker).agg(
        F.count_distinct(species).alias("species"), F.count_distinct(sample).alias("samples"), F.avg(length).alias("mean_length")
    )
    out = markers.select(marker).distinct().join(own, marker, "left").na.fill(0, ["species", "samples"]).crossJoin(F.broadcast(total))  # one row
    out = out.withColumn("occupancy", F.col("species") / F.col("total")).withColumn("eligible", F.col("species") >= decimal_ceiling(min_taxa, F.col("total")))
    out = stored(out.drop("total"), "coverage")
    placed = numbered(out.where("eligible"), [F.col("species").desc(), F.col(marker)]).withColumn("place", F.col("place") + 1)
    return placed.unionByName(out.where("not eligible"), allowMissingColumns=True)


def best_markers(coverage: DataFrame, most: int | None = None, marker: str = "marker") -> DataFrame:
    own = coverage.where("eligible").orderBy(F.col("species").desc(), marker)
    return own if most is None else own.limit(most)


def gene_tree_coverage(tips: DataFrame, samples: DataFrame, tree: str = "tree_id", sample: str = "sample") -> DataFrame:
    """(sample, trees): zeros included."""
    own = tips.groupBy(sample).agg(F.count_distinct(tree).alias("trees"))
    return samples.select(sample).distinct().join(own, sample, "left").na.fill(0, ["trees"])


def tree_occupancy(tips: DataFrame, samples: DataFrame, tree: str = "tree_id", sample: str = "sample") -> DataFrame:
    total = samples.agg(F.count_distinct(sample).alias("total"))
    return tips.groupBy(tree).agg(F.count_distinct(sample).alias("samples")).crossJoin(F.broadcast(total)).select(tree, "samples", (F.col("samples") / F.col("total")).alias("occupancy"))  # one row


def gene_tree_summary(trees: DataFrame, tips: DataFrame, samples: DataFrame, tree: str = "tree_id", sample: str = "sample", status: str = "status", sites: str = "sites") -> DataFrame:
    """One row: trees retained and excluded (trees(tree, status, sites)), total and mean sites of the retained, samples, those that no retained
    tree holds, tips that are no sample, and the status, insufficient_coverage if a sample is left out or no tree is left."""
    kept = trees.where(F.col(status) == "retained")
    of = kept.agg(F.count("*").alias("retained"), F.coalesce(F.sum(sites), F.lit(0)).alias("total_sites"), F.coalesce(F.avg(sites), F.lit(0.0)).alias("mean_sites"))
    seen = tips.join(kept.select(tree), tree, "left_semi").select(sample).distinct().withColumn("__seen", F.lit(1))
    both = samples.select(sample).distinct().withColumn("__own", F.lit(1)).join(seen, sample, "full")
    who = both.agg(F.count("__own").alias("samples"), F.count_if(F.col("__seen").isNull()).alias("unrepresented"), F.count_if(F.col("__own").isNull()).alias("unexpected"))
    gone = trees.agg(F.count_if(~F.coalesce(F.col(status) == "retained", F.lit(False))).alias("excluded"))
    one = of.crossJoin(F.broadcast(gone)).crossJoin(F.broadcast(who))  # a row each
    return one.withColumn("status", F.when((F.col("unrepresented") > 0) | (F.col("retained") == 0), "insufficient_coverage").otherwise("retained"))


def unrepresented(tips: DataFrame, samples: DataFrame, sample: str = "sample") -> DataFrame:
    """Samples that no tree holds."""
    return samples.select(sample).distinct().join(tips.select(sample).distinct(), sample, "left_anti")


def coverage_distribution(coverage: DataFrame, count: str = "trees") -> DataFrame:
    return coverage.groupBy(count).agg(F.count("*").alias("samples"))


def alignment_sites(alignment: DataFrame, marker: str = "marker", seq: str = "seq", gaps: str = "-X?*") -> DataFrame:
    """(marker, rows, columns, variable_sites, informative_sites): a column varies with two residues, and informs with two
    residues seen twice or more. Columns are exploded in the scan's stage and counted before the shuffle."""
    cells = alignment.select(marker, F.posexplode(F.split(seq, "")).alias("at", "aa")).where(F.col("aa") != "")
    real = ~F.col("aa").isin(*gaps)
    per_residue = cells.groupBy(marker, "at", "aa").agg(F.count("*").alias("n"))
    per_column = per_residue.groupBy(marker, "at").agg(F.count_if(real).alias("residues"), F.count_if(real & (F.col("n") >= 2)).alias("twice"))
    sites = per_column.groupBy(marker).agg(F.count("*").alias("columns"), F.count_if(F.col("residues") >= 2).alias("variable_sites"), F.count_if(F.col("twice") >= 2).alias("informative_sites"))
    return alignment.groupBy(marker).agg(F.count("*").alias("rows")).join(sites, marker, "left").na.fill(0)


def long_enough(alignment: DataFrame, least: int, seq: str = "seq", gaps: str = "-X?") -> DataFrame:
    """Rows with that many known residues."""
    return alignment.where(F.length(F.translate(seq, gaps, "")) >= least)


def reference_panel(proteins: DataFrame, marker: str = "marker", organism: str = "organism", species: str = "species", is_subspecies: str = "is_subspecies") -> DataFrame:
    """(marker, organism) with one protein, of the best organism of each species: most markers, then no subspecies, then id."""
    single = proteins.groupBy(marker, organism, species, is_subspecies).agg(F.count("*").alias("n")).where("n = 1").drop("n")
    best = single.groupBy(species, organism, is_subspecies).agg(F.count("*").alias("markers"))
    best = best.groupBy(species).agg(F.min_by(organism, F.struct(-F.col("markers"), F.col(is_subspecies), F.col(organism))).alias(organism))
    return single.join(best, [species, organism], "left_semi").select(marker, organism, species)


def recovered_loci(sequences: DataFrame, least: int = 150, run: str = "run", locus: str = "locus", seq: str = "seq") -> DataFrame:
    """(run, locus, seq): loci with one distinct sequence of that length or more."""
    own = sequences.groupBy(run, locus).agg(F.count_distinct(seq).alias("n"), F.min(seq).alias(seq))
    return own.where((F.col("n") == 1) & (F.length(seq) >= least)).drop("n")
