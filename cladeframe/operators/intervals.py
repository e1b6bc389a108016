"""Sums, neighbours and minima along positions, the columns `at` (from 0, dense) of each `by`.

A tree's tips in order are such positions, and a node is the interval of its tips, so that counts below nodes are
differences of prefix sums. Every operator works in bins of positions and then over the bins, so no task orders a whole
tree and nothing grows with a tree's depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN, SMALL_BIN_BITS = 4096, 8


def _binned(df: DataFrame, by: str) -> tuple[DataFrame, Window, Window]:
    return df.withColumn("__bin", F.floor(F.col("at") / BIN)), Window.partitionBy(by, "__bin").orderBy("at"), Window.partitionBy(by).orderBy("__bin")


def prefix_sums(df: DataFrame, values: dict[str, Column], by: str = "tree_id") -> DataFrame:
    """df, one row for each position, with the sum of each value up to and with its position."""
    own, inside, over = _binned(df.select("*", *[v.alias(f"__{name}") for name, v in values.items()]), by)
    sums = own.groupBy(by, "__bin").agg(*[F.sum(f"__{name}").alias(name) for name in values])
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(by, "__bin", *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"__{name}_before") for name in values])
    own = own.join(sums, [by, "__bin"])
    each = [(F.col(f"__{name}_before") + F.sum(f"__{name}").over(inside.rowsBetween(Window.unboundedPreceding, 0))).alias(name) for name in values]
    return own.select(*df.columns, *each)


def nearest(df: DataFrame, value: Column, by: str = "tree_id", name: str = "near", after: bool = False) -> DataFrame:
    """df, one row for each position, with the value of the nearest position at or before it (after: at or after it) whose
    value isn't null."""
    own, inside, over = _binned(df.withColumn("__value", value), by)
    pick = F.first if after else F.last
    rows = (0, Window.unboundedFollowing) if after else (Window.unboundedPreceding, 0)
    other = (1, Window.unboundedFollowing) if after else (Window.unboundedPreceding, -1)
    best = (F.min_by if after else F.max_by)("__value", F.when(F.col("__value").isNotNull(), F.col("at")))
    bins = own.groupBy(by, "__bin").agg(best.alias("__value"))
    bins = bins.select(by, "__bin", pick("__value", ignorenulls=True).over(over.rowsBetween(*other)).alias("__beyond"))
    found = F.coalesce(pick("__value", ignorenulls=True).over(inside.rowsBetween(*rows)), F.col("__beyond"))
    return own.join(bins, [by, "__bin"]).select(*df.columns, found.alias(name))


def previous_equal(df: DataFrame, key: str, by: str = "tree_id", name: str = "before") -> DataFrame:
    """df with the last position before a row's own that has the same key in the same `by`."""
    own = df.withColumn("__bin", F.floor(F.col("at") / BIN))
    last = own.groupBy(by, key, "__bin").agg(F.max("at").alias("__last"))
    last = last.select(by, F.col(key).alias("__key"), "__bin", F.lag("__last").over(Window.partitionBy(by, key).orderBy("__bin")).alias("__earlier"))
    own = own.withColumn("__inside", F.lag("at").over(Window.partitionBy(by, key, "__bin").orderBy("at")))
    out = own.withColumnRenamed(key, "__key").join(last, [by, "__key", "__bin"], "left").withColumnRenamed("__key", key)
    return out.select(*df.columns, F.coalesce("__inside", "__earlier").alias(name))


def _halves(points: DataFrame, kinds: Column, by: str) -> DataFrame:
    """(by, kind, at, x): running minima within blocks, away from the middle of the pair of blocks that a kind has."""
    each = points.withColumn("kind", F.explode(kinds))
    level = F.when(F.col("kind") >= 100, F.col("kind") - 100).otherwise(F.col("kind"))
    block = F.when(F.col("kind") == SMALL_BIN_BITS, 2 * F.shiftright("at", SMALL_BIN_BITS)).when(F.col("kind") == SMALL_BIN_BITS + 1, 2 * F.shiftright("at", SMALL_BIN_BITS) + 1)
    each = each.withColumn("block", F.coalesce(block, F.call_function("shiftright", F.col("at"), level)))
    order = F.when(F.col("block") % 2 == 1, F.col("at")).otherwise(-F.col("at"))
    over = Window.partitionBy(by, "kind", "block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return each.select(by, "kind", "at", F.min("x").over(over).alias("x"))


def least_between(points: DataFrame, queries: DataFrame, by: str = "tree_id") -> DataFrame:
    """queries (by, lo, hi, ...) with `least`, the position from lo to hi where points (by, at, v) have their smallest v, the
    first of equal ones. A query looks up two places of a table of running minima, or four if it spans bins."""
    bits = SMALL_BIN_BITS
    points = points.select(by, F.col("at").cast("long").alias("at"), F.struct("v", F.col("at").cast("long").alias("at")).alias("x"))
    bins = points.groupBy(by, F.shiftright("at", bits).alias("at")).agg(F.min("x").alias("x"))
    top = (bins.agg(F.max("at")).first()[0] or 0).bit_length()
    table = _halves(points, F.array(*[F.lit(k) for k in range(bits + 2)]), by).union(_halves(bins, F.array(*[F.lit(100 + k) for k in range(top + 1)]), by))
    lo, hi = F.col("lo").cast("long"), F.col("hi").cast("long")
    a, b = F.shiftright(lo, bits) + 1, F.shiftright(hi, bits) - 1
    bit = lambda x, y: F.length(F.bin(x.bitwiseXOR(y))) - 1
    look = lambda kind, at: F.struct(F.lit(kind).cast("int").alias("kind") if isinstance(kind, int) else kind.cast("int").alias("kind"), at.alias("at"))
    none = F.array().cast("array<struct<kind:int,at:bigint>>")
    inside = F.when(lo == hi, F.array(look(0, lo))).otherwise(F.array(look(bit(lo, hi), lo), look(bit(lo, hi), hi)))
    between = F.when(a > b, none).when(a == b, F.array(look(100, a))).otherwise(F.array(look(100 + bit(a, b), a), look(100 + bit(a, b), b)))
    ways = F.when(a == b + 2, inside).otherwise(F.concat(F.array(look(bits, lo), look(bits + 1, hi)), between))
    asked = queries.withColumn("__way", F.explode(ways)).select(*queries.columns, F.col("__way.kind").alias("kind"), F.col("__way.at").alias("at"))
    found = asked.join(table, [by, "kind", "at"]).groupBy(*queries.columns).agg(F.min("x").alias("x"))
    return found.select(*queries.columns, F.col("x.at").alias("least"))
