"""Exact sums of doubles over their whole range.

Every double is a whole number times a power of two. It is split into four digits to the base 2^18, which are added by the place of the
first as whole numbers of 64 bits (room for 2^45 values in one place of a group); no order or partitioning changes these. The sums of a
group's places, a few numbers, are rounded once to the nearest double, ties to even. So the result is the double nearest to the true sum.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_BITS, DIGITS = 18, 4
#: Places of a first digit: those of 2^-1074 and of 2^1023.
LOWEST, HIGHEST = -1074 // BASE_BITS, 1023 // BASE_BITS


def _rounded(sums: list[list[int]]) -> float:
    """The double nearest to the sum of [place, sums of the digits from that place down]; infinite beyond all doubles."""
    total = 0
    for place, *digits in sums:
        n = 0
        for digit in digits:
            n = (n << BASE_BITS) + digit
        total += n << (place - LOWEST) * BASE_BITS
    try:
        return total / (1 << (DIGITS - 1 - LOWEST) * BASE_BITS)  # of whole numbers: rounded once, ties to even
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def _nearest(groups: pa.Array) -> pa.Array:
    return pa.array([_rounded(sums.as_py()) for sums in groups], pa.float64())


def with_digits(df: DataFrame, value: str) -> DataFrame:
    """df with __place and __d0 to __d3: a finite double not 0 is the sum of __dk * 2^(18 * (__place - k)); null beside null."""
    # Powers of 2 come from a table; twice half of a power, as the whole one may be no double.
    halves = F.lit([2.0 ** (-place * BASE_BITS // 2) for place in range(LOWEST, HIGHEST + 1)])
    # The logarithm may be off by a little near a power of two. The first digit is then 2^18, or 0 before digits that still hold all bits:
    # those of a number just below 1 end at 2^-53, and the digits at 2^-54.
    place = F.floor(F.ln(F.abs(value)) / (BASE_BITS * math.log(2))).cast("int")
    out = df.withColumn("__place", place).withColumn("__half", F.get(halves, F.col("__place") - LOWEST))
    out = out.withColumn("__left", F.col(value) * F.col("__half") * F.col("__half"))
    for k in range(DIGITS):
        out = out.withColumn(f"__d{k}", F.col("__left").cast("bigint"))
        out = out.withColumn("__left", (F.col("__left") - F.col(f"__d{k}")) * 2.0**BASE_BITS)
    return out.drop("__half", "__left")


def exact_sums(df: DataFrame, value: str, keys: list[str], name: str = "total") -> DataFrame:
    """(keys, total, problem): the double nearest to the true sum of a column of doubles or numbers held as text; nulls count as nothing. total
    is null where the problem says not_finite (a value is no finite number) or overflow (the sum is beyond all doubles)."""
    x = F.col(value).try_cast("double")
    odd = F.col(value).isNotNull() & (x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    own = df.select(*keys, x.alias("__x"), odd.alias("__odd")).withColumn("__x", F.when(~F.col("__odd") & (F.col("__x") != 0), F.col("__x")))
    digits = [f"__d{k}" for k in range(DIGITS)]
    sums = with_digits(own, "__x").groupBy(*keys, "__place").agg(F.max("__odd").alias("__odd"), *[F.sum(d).alias(d) for d in digits])
    places = F.when(F.col("__place").isNotNull(), F.array(F.col("__place").cast("bigint"), *digits))
    both = sums.groupBy(*keys).agg(F.max("__odd").alias("__odd"), F.collect_list(places).alias("__places"))
    both = both.withColumn("__total", F.when(~F.col("__odd"), F.arrow_udf(_nearest, "double")("__places")))
    far = F.abs(F.col("__total")) == float("inf")
    return both.select(*keys, F.when(~far, F.col("__total")).alias(name), F.when(F.col("__odd"), "not_finite").when(far, "overflow").alias("problem"))
