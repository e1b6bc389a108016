"""Gene-to-group mapping: building, quality counts, reuse, occupancy, members."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.functions.text import decimal_ceiling


def map_genes(genes: DataFrame, pairs: DataFrame, sample: str = "sample", gene: str = "gene_id", group: str = "orthogroup") -> DataFrame:
    """All genes with their distinct groups; a gene without one stays, with null. Pairs of unknown genes: foreign_pairs."""
    own = pairs.where(F.col(group) != "").select(sample, gene, group).distinct()
    return genes.select(sample, gene).distinct().join(own, [sample, gene], "left")


def foreign_pairs(genes: DataFrame, pairs: DataFrame, sample: str = "sample", gene: str = "gene_id") -> DataFrame:
    return pairs.select(sample, gene).distinct().join(genes.select(sample, gene).distinct(), [sample, gene], "left_anti")


def mapping_counts(genes: DataFrame, pairs: DataFrame, sample: str = "sample", gene: str = "gene_id", group: str = "orthogroup") -> DataFrame:
    """(sample, protein_genes, unique_gene_og_pairs, input_annotation_rows, duplicate_pairs_removed, ambiguous_genes)."""
    distinct = pairs.groupBy(sample, gene, group).agg(F.count("*").alias("rows"))
    per_gene = distinct.groupBy(sample, gene).agg(F.count("*").alias("groups"), F.sum("rows").alias("rows"))
    own = per_gene.groupBy(sample).agg(F.sum("groups").alias("unique_gene_og_pairs"), F.sum("rows").alias("input_annotation_rows"), F.count_if(F.col("groups") > 1).alias("ambiguous_genes"))
    out = genes.select(sample, gene).distinct().groupBy(sample).agg(F.count("*").alias("protein_genes")).join(own, sample, "left").na.fill(0)
    return out.withColumn("duplicate_pairs_removed", F.col("input_annotation_rows") - F.col("unique_gene_og_pairs"))


def mapping_totals(counts: DataFrame, sample: str = "sample") -> DataFrame:
    return counts.agg(*[F.sum(c).alias(c) for c in counts.columns if c != sample])


def occupancy(mapping: DataFrame, fraction: str, sample: str = "sample", group: str = "orthogroup", samples: DataFrame | None = None) -> DataFrame:
    """(group, samples, total, fraction, selected): distinct samples of each group; the cut is inclusive and exact."""
    total = (samples if samples is not None else mapping).agg(F.count_distinct(sample).alias("total"))
    out = mapping.where(F.col(group).isNotNull()).groupBy(group).agg(F.count_distinct(sample).alias("samples"))
    out = out.crossJoin(F.broadcast(total))  # one row
    return out.withColumn("fraction", F.col("samples") / F.col("total")).withColumn("selected", F.col("samples") >= decimal_ceiling(fraction, F.col("total")))


def members(proteins: DataFrame, mapping: DataFrame, sample: str = "sample", gene: str = "gene_id", group: str = "orthogroup") -> DataFrame:
    """Proteins of each group. Mapped genes without a protein: missing_proteins."""
    return proteins.join(mapping.where(F.col(group).isNotNull()).select(sample, gene, group), [sample, gene])


def missing_proteins(proteins: DataFrame, mapping: DataFrame, sample: str = "sample", gene: str = "gene_id", group: str = "orthogroup") -> DataFrame:
    return mapping.where(F.col(group).isNotNull()).join(proteins.select(sample, gene).distinct(), [sample, gene], "left_anti")


def reuse_plan(wanted: DataFrame, snapshots: DataFrame, sample: str = "sample", content: str = "sha256", priority: str = "priority", source: str = "source") -> DataFrame:
    """(sample, content, action, source): reuse from the first snapshot by priority that holds the same content, else missing."""
    best = snapshots.groupBy(sample, content).agg(F.min_by(source, F.struct(priority, source)).alias(source))
    out = wanted.select(sample, content).distinct().join(best, [sample, content], "left")
    return out.withColumn("action", F.when(F.col(source).isNull(), "missing").otherwise("reuse"))


def reuse_conflicts(entries: DataFrame, sample: str = "sample", content: str = "sha256") -> DataFrame:
    """Samples that databases hold with different contents."""
    return entries.groupBy(sample).agg(F.count_distinct(content).alias("contents")).where("contents > 1")


def reuse_best(entries: DataFrame, sample: str = "sample", content: str = "sha256", source: str = "source", has_mapping: str = "has_mapping", has_reference: str = "has_reference") -> DataFrame:
    """For samples without conflict the entry to take: with mapping before with reference, then the first source."""
    lack = F.struct((~F.col(has_mapping)).alias("m"), (~F.col(has_reference)).alias("r"), F.col(source).alias("s"))
    best = entries.groupBy(sample).agg(F.min_by(F.struct(content, source, has_mapping, has_reference), lack).alias("r"), F.count_distinct(content).alias("n"))
    return best.where("n = 1").select(sample, "r.*")


def strip_hit(hit: str = "hit"):
    """Sequence id of a hit: without :from-to and strand."""
    return F.regexp_replace(F.col(hit), r":[0-9]+-[0-9]+(?:[|][+-])?\z", "")


def hits_with_sequences(hits: DataFrame, sequences: DataFrame, hit: str = "hit", sample: str = "sample", gene: str = "gene_id") -> DataFrame:
    """Hits with the sequence they name, and problem: missing or doubly_matched (null if fine)."""
    own = hits.withColumn(gene, strip_hit(hit))
    counted = sequences.withColumn("__n", F.count("*").over(Window.partitionBy(sample, gene)))
    out = own.join(counted, [sample, gene], "left")
    return out.withColumn("problem", F.when(F.col("__n").isNull(), "missing").when(F.col("__n") > 1, "doubly_matched")).drop("__n")
