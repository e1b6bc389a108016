"""Expression by gene group, in long and wide form, with its quality counts and reconciliation.

Values are summed as decimals, which don't depend on order, and divided once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.functions.text import exact, number
from cladeframe.operators.checks import check_close

MILLION = 1_000_000


def group_expression(abundance: DataFrame, mapping: DataFrame, sample: str = "sample", gene: str = "gene_id", group: str = "orthogroup", value: str = "tpm") -> DataFrame:
    """(sample, group, tpm_sum, tpm): sums per group and, per sample, their share of all mapped genes times a million.

    The mapping is made distinct first, so a repeated pair counts once. One shuffle by sample and gene for the join, and
    one of partial sums; the denominator is a window over the sums.
    """
    pairs = mapping.where(F.col(group).isNotNull()).select(sample, gene, group).distinct()
    joined = abundance.select(sample, gene, exact(F.col(value)).alias("v")).join(pairs, [sample, gene])
    sums = joined.groupBy(sample, group).agg(F.sum("v").alias("s"))
    whole = F.sum("s").over(Window.partitionBy(sample))
    return sums.select(sample, group, F.col("s").cast("double").alias("tpm_sum"), F.when(whole > 0, F.col("s").cast("double") / whole.cast("double") * MILLION).alias("tpm"))


def ambiguous_genes(mapping: DataFrame, sample: str = "sample", gene: str = "gene_id", group: str = "orthogroup") -> DataFrame:
    return mapping.where(F.col(group).isNotNull()).groupBy(sample, gene).agg(F.count_distinct(group).alias("groups")).where("groups > 1")


def expression_quality(abundance: DataFrame, mapping: DataFrame, sample: str = "sample", gene: str = "gene_id", group: str = "orthogroup", value: str = "tpm") -> DataFrame:
    """Per sample: targets, protein_genes, quantified_proteins, mapped, ambiguous and retained targets, groups, totals
    and fractions. A gene of the mapping without a group is a protein gene that isn't mapped."""
    per_gene = mapping.groupBy(sample, gene).agg(F.count_distinct(group).alias("groups"), F.lit(True).alias("protein"))
    both = abundance.select(sample, gene, exact(F.col(value)).alias("v"), F.lit(True).alias("target")).join(per_gene, [sample, gene], "full")
    target, protein = F.coalesce("target", F.lit(False)), F.coalesce("protein", F.lit(False))
    groups = F.coalesce("groups", F.lit(0))
    total = lambda rule: F.coalesce(F.sum(F.when(rule, F.col("v"))), F.lit(0)).cast("double")
    out = both.groupBy(sample).agg(
        F.count_if(target).alias("targets"), F.count_if(protein).alias("protein_genes"), F.count_if(target & protein).alias("quantified_proteins"),
        F.count_if(target & (groups > 0)).alias("mapped_targets"), F.count_if(target & (groups > 1)).alias("ambiguous_targets"), F.count_if(target & (groups == 1)).alias("retained_targets"),
        total(target).alias("total_tpm"), total(target & (groups > 0)).alias("mapped_tpm"), total(target & (groups == 1)).alias("retained_tpm"),
    )
    seen = abundance.select(sample, gene).join(mapping.where(F.col(group).isNotNull()).select(sample, gene, group).distinct(), [sample, gene])
    out = out.join(seen.groupBy(sample).agg(F.count_distinct(group).alias("orthogroups")), sample, "left").na.fill(0, ["orthogroups"])
    share = lambda c: F.when(F.col("total_tpm") > 0, F.col(c) / F.col("total_tpm")).otherwise(0.0)
    return out.withColumn("mapped_tpm_fraction", share("mapped_tpm")).withColumn("retained_tpm_fraction", share("retained_tpm"))


def feature_axis(df: DataFrame, feature: str) -> DataFrame:
    return df.select(feature).distinct().orderBy(feature)


def wide(df: DataFrame, sample: str, feature: str, value: str, axis: list[str] | None = None, fill: float | None = None) -> DataFrame:
    """One row per sample, one column per feature of the axis. Zero fill is for group tables; function tables keep null.
    Give the axis, or it is collected (bounded by spark.sql.pivotMaxValues); for larger axes use wide_map."""
    out = df.groupBy(sample).pivot(feature, axis).agg(F.first(value)) if axis else df.groupBy(sample).pivot(feature).agg(F.first(value))
    return out if fill is None else out.na.fill(fill)


def wide_map(df: DataFrame, sample: str, feature: str, value: str) -> DataFrame:
    """(sample, values): one map per sample, for axes too wide for columns."""
    return df.groupBy(sample).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(feature, value)))).alias("values"))


def wide_chunks(df: DataFrame, sample: str, feature: str, value: str, axis: list[str], size: int = 5000, fill: float | None = None) -> list[DataFrame]:
    """Pivots of `size` features each."""
    return [wide(df, sample, feature, value, axis[i : i + size], fill) for i in range(0, len(axis), size)]


def sequence_table(abundance: DataFrame, mapping: DataFrame, sample: str = "sample", gene: str = "gene_id", group: str = "orthogroup", value: str = "tpm") -> DataFrame:
    """(sample, gene, groups, value text, value): every sequence of every sample, zeros and unmapped kept, text unchanged."""
    own = mapping.where(F.col(group).isNotNull()).groupBy(sample, gene).agg(F.array_join(F.array_sort(F.collect_set(group)), ";").alias("groups"))
    text = F.col(value).cast("string")
    return abundance.select(sample, gene, text.alias(f"{value}_text"), number(text).alias(value)).join(own, [sample, gene], "left")


def renormalised_error(df: DataFrame, sample: str = "sample", total: str = "tpm_sum", share: str = "tpm", relative: float = 1e-9) -> DataFrame:
    """Rows whose share isn't total / sum of totals * 1e6: the table re-derived."""
    whole = F.sum(exact(F.col(total))).over(Window.partitionBy(sample)).cast("double")
    return check_close(df.withColumn("expected", F.col(total) / whole * MILLION), "expected", share, relative)


def reconcile(expected: DataFrame, actual: DataFrame, keys: list[str], value: str, relative: float = 1e-9, absolute: float = 0.0) -> DataFrame:
    """(keys, expected, actual): where two tables differ beyond tolerance or one lacks a key."""
    both = expected.select(*keys, F.col(value).alias("expected"), F.lit(1).alias("__a")).join(actual.select(*keys, F.col(value).alias("actual"), F.lit(1).alias("__b")), keys, "full")
    alone = both.where("__a is null or __b is null")
    return alone.unionByName(check_close(both.where("__a is not null and __b is not null"), "expected", "actual", relative, absolute)).drop("__a", "__b")


def before_after(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """(table, rows_before, rows_after)."""
    count = lambda name, df, side: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), F.lit(side).alias("side"), "n")
    parts = [count(k, df, side) for side, tables in (("rows_before", before), ("rows_after", after)) for k, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.groupBy("table").pivot("side", ["rows_before", "rows_after"]).agg(F.first("n"))


def total_of(df: DataFrame, value: str, by: str, rule: Column | None = None) -> DataFrame:
    """Exact sum per key: decimals in, one double out."""
    v = exact(F.col(value))
    return df.groupBy(by).agg(F.sum(v if rule is None else F.when(rule, v)).cast("double").alias(value))
