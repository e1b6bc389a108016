"""Constraint checks: each returns the rows that violate it; require() fails on any."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeframe.functions.text import is_close, number, sample_of_gene


class CheckFailed(ValueError):
    """A required check found violations."""


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n): keys that stand more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def check_foreign_key(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of df that other lacks."""
    return df.select(*keys).distinct().join(other.select(*keys).distinct(), list(keys), "left_anti")


def check_functional(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, n): keys with more than one value, null counting as one."""
    return df.groupBy(*keys).agg(F.count_distinct(F.struct(value)).alias("n")).where("n > 1")


def check_allowed(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """(column, n): values that aren't allowed; null isn't."""
    return df.where(~F.coalesce(F.col(column).isin(*allowed), F.lit(False))).groupBy(column).agg(F.count("*").alias("n"))


def check_disjoint(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct().join(other.select(*keys).distinct(), list(keys), "left_semi")


def check_coverage(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, side): keys in one of two tables only; side is missing (not in df) or extra."""
    a, b = df.select(*keys).distinct(), other.select(*keys).distinct()
    extra = a.join(b, list(keys), "left_anti").withColumn("side", F.lit("extra"))
    return extra.unionByName(b.join(a, list(keys), "left_anti").withColumn("side", F.lit("missing")))


def check_numbers(df: DataFrame, column: str, nonnegative: bool = True) -> DataFrame:
    """Rows whose text isn't a finite number."""
    return df.where(number(F.col(column), nonnegative).isNull())


def check_close(df: DataFrame, expected: str, actual: str, relative: float = 1e-9, absolute: float = 0.0) -> DataFrame:
    """Rows where two values differ beyond tolerance, or one only is null."""
    same = is_close(F.col(expected), F.col(actual), relative, absolute)
    return df.where((F.col(expected).isNull() != F.col(actual).isNull()) | ~F.coalesce(same, F.lit(True)))


def check_expression(table: DataFrame, runs: DataFrame, sample: str = "sample", feature: str = "gene_id", value: str = "tpm") -> DataFrame:
    """(rule, sample, detail): each (sample, feature) once, values finite and not negative, genes of their sample, every
    run present, no run unknown. One pass for row rules, one aggregation for the others."""
    own = table.select(F.col(sample).alias("sample"), F.col(feature).alias("detail"), F.col(value).cast("string").alias("v"))
    rules = F.array_compact(F.array(F.when(number(F.col("v")).isNull(), F.lit("bad value")), F.when(~sample_of_gene(F.col("detail")).eqNullSafe(F.col("sample")), F.lit("foreign gene"))))
    rows = own.select(F.explode(rules).alias("rule"), "sample", "detail")
    twice = own.groupBy("sample", "detail").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("repeated").alias("rule"), "sample", "detail")
    axis = check_coverage(own, runs.select(F.col(sample).alias("sample")), ["sample"])
    return rows.union(twice).union(axis.select(F.concat_ws(" ", "side", F.lit("sample")), "sample", F.lit(None).cast("string")))


def count_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row: for each named row rule, how many rows break it. One pass for all."""
    return df.agg(*[F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])


def require(*violations: DataFrame, examples: int = 5) -> None:
    """Raise CheckFailed with a few examples if any check has rows."""
    for found in violations:
        rows = found.limit(examples).collect()
        if rows:
            raise CheckFailed(f"{len(rows)} or more violations, such as {[r.asDict() for r in rows]}")


def tagged(checks: dict[str, DataFrame]) -> DataFrame:
    """All violations in one table: (check, row as JSON)."""
    return reduce(DataFrame.unionByName, [v.select(F.lit(k).alias("check"), F.to_json(F.struct("*")).alias("row")) for k, v in checks.items()])
