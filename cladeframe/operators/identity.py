"""Samples, species and accessions: identities, names, selectors, open schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeframe.functions import text as T


def annotate_samples(df: DataFrame, name: str = "scientific_name", run: str = "run") -> DataFrame:
    """Adds species_id, analysis_sample_id and odb_species, and conflict: which supplied value disagrees (null if none)."""
    made = {"species_id": T.species_id(F.col(name)), "analysis_sample_id": T.analysis_sample_id(F.col(name), F.col(run))}
    supplied = {c: F.nullif(F.col(c), F.lit("")) if c in df.columns else F.lit(None).cast("string") for c in made}
    clash = F.coalesce(*[F.when(supplied[c].isNotNull() & (supplied[c] != made[c]), F.lit(c)) for c in made])
    out = df.withColumns(made | {"conflict": clash})
    return out.withColumn("odb_species", T.odb_species(F.col("analysis_sample_id")))


def identity_collisions(df: DataFrame, key: str = "odb_species") -> DataFrame:
    """(key, n): names that two samples share after normalisation."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def clean_names(df: DataFrame, name: str = "scientific_name", kept: str = "original_name") -> DataFrame:
    return df.withColumn(kept, F.col(name)).withColumn(name, T.clean_scientific_name(F.col(name)))


def canonical_taxids(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Taxid columns as long; bad: those that hold something else (null if none)."""
    bad = F.coalesce(*[F.when(T.taxid_invalid(F.col(c)), F.lit(c)) for c in columns])
    return df.withColumn("bad", bad).withColumns({c: T.canonical_taxid(F.col(c)) for c in columns})


def normalize_traits(df: DataFrame, trait: str, name: str = "species") -> DataFrame:
    """(species_id, trait, bad): missing tokens are null, bad is true for values other than 0 and 1."""
    value = T.trait_value(F.col(trait))
    return df.select(T.species_id(F.trim(F.col(name))).alias("species_id"), value.alias(trait), (value.isNotNull() & ~value.isin("0", "1")).alias("bad"))


def coalesce_aliases(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Old column names to new: values of the new win; conflict names the new column where both are set and differ."""
    clashes, out = [], df
    for new, old in aliases.items():
        if old in df.columns and new in df.columns:
            clashes.append(F.when(F.col(new).isNotNull() & F.col(old).isNotNull() & (F.col(new) != F.col(old)), F.lit(new)))
    out = out.withColumn("conflict", F.coalesce(*clashes) if clashes else F.lit(None).cast("string"))
    for new, old in aliases.items():
        if old in df.columns:
            out = out.withColumn(new, F.coalesce(new, old) if new in df.columns else F.col(old)).drop(old)
    return out


def union_open(*frames: DataFrame, fill: str | None = "") -> DataFrame:
    """Union of the columns in first-seen order; what a table lacks is filled."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out if fill is None else out.na.fill(fill)


def relabel_genes(df: DataFrame, names: DataFrame, gene: str = "gene_id") -> DataFrame:
    """Gene ids re-keyed by names(old, new) of samples; other fields and other samples' genes stay."""
    own = df.withColumn("__old", T.sample_of_gene(F.col(gene)))
    renamed = names.select(F.col("old").alias("__old"), F.col("new").alias("__new"))
    out = own.join(renamed, "__old", "left")
    tail = F.substring(F.col(gene), F.length("__old") + 1, F.length(gene))
    return out.withColumn(gene, F.when(F.col("__new").isNull(), F.col(gene)).otherwise(F.concat("__new", tail))).select(*df.columns)


def expand_selectors(samples: DataFrame, requested: DataFrame, species: str = "species_id", sample: str = "sample", selector: str = "selector") -> DataFrame:
    """Distinct samples of the request: a species id stands for all its samples, a sample id for itself."""
    alias = samples.select(F.explode(F.array_distinct(F.array(species, sample))).alias(selector), sample)
    return alias.join(requested.select(selector).distinct(), selector).select(sample).distinct()


def unknown_selectors(samples: DataFrame, requested: DataFrame, species: str = "species_id", sample: str = "sample", selector: str = "selector") -> DataFrame:
    alias = samples.select(F.explode(F.array(species, sample)).alias(selector))
    return requested.select(selector).distinct().join(alias, selector, "left_anti")


def inherit_trait(samples: DataFrame, traits: DataFrame, trait: str, species: str = "species_id") -> DataFrame:
    """Every sample with its species' trait, null where missing."""
    return samples.join(traits.select(species, trait), species, "left")


def phenotyped(samples: DataFrame, trait: str) -> DataFrame:
    return samples.where(F.col(trait).isNotNull())


def read_evidence(df: DataFrame, first: str, second: str) -> DataFrame:
    """evidence: the value two stages agree on, mixed where they differ, unknown where one is missing."""
    a, b = F.nullif(F.col(first), F.lit("")), F.nullif(F.col(second), F.lit(""))
    return df.withColumn("evidence", F.when(a.isNull() | b.isNull(), "unknown").when(a == b, a).otherwise("mixed"))
