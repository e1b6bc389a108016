"""Exact sums: every digit of every double, in one pass over the values."""

import math
from fractions import Fraction

import duckdb
import pytest
from cladeframe.operators.sums import BASE_BITS, DIGITS, exact_sums, with_digits
from cladeframe.plans import star
from pyspark.sql import functions as F
from tests.conftest import SF


def test_values_are_read_once_and_no_arrays_are_made_of_them(spark):
    # F1: a join of two reads, and arrays of digits by functions that Spark interprets, took 18 microseconds a value
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    plan = exact_sums(df, "v", ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1
    assert "Join" not in plan and "lambda" not in plan and "explode" not in plan


def test_digits_hold_every_bit(spark):
    powers = [2.0**k for k in range(-1074, 1024)]
    near = [v for p in powers for v in (math.nextafter(p, 0.0), p, math.nextafter(p, math.inf))] + [1.7976931348623157e308, 0.1, 1 / 3]
    values = [s * v for v in near for s in (1, -1) if v]
    rows = with_digits(spark.createDataFrame([(v,) for v in values], "v double"), "v").collect()
    assert len(rows) == len(values)
    for r in rows:
        digits = [r[f"__d{k}"] for k in range(DIGITS)]
        assert sum(d * Fraction(2) ** (BASE_BITS * (r["__place"] - k)) for k, d in enumerate(digits)) == Fraction(r.v), r
        assert all(abs(d) <= 1 << BASE_BITS for d in digits), r
    assert [tuple(r) for r in with_digits(spark.createDataFrame([(None,)], "v double"), "v").collect()] == [(None,) * (2 + DIGITS)]


def test_many_values_in_one_group(spark):
    n = 1_000_000
    v = F.array(F.lit(2.0**53 - 1), F.lit(0.1), F.lit(-1 / 3), F.when(F.col("id") == 7, 5e-324))
    got = exact_sums(spark.range(n).select(F.explode(v).alias("v")).withColumn("g", F.lit("all")), "v", ["g"]).collect()
    want = n * (Fraction(2**53 - 1) + Fraction(0.1) - Fraction(1 / 3)) + Fraction(5e-324)
    assert [tuple(r) for r in got] == [("all", want.numerator / want.denominator, None)]


def test_sums_beyond_all_doubles_have_both_signs(spark):
    top = 1.7976931348623157e308
    groups = {"up": [top, top], "down": [-top, -top], "half": [top, 2.0**970], "under": [top, 2.0**970 - 2.0**917], "back": [top, top, -top, -top, 2.5]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    got = {r.g: (r.total, r.problem) for r in exact_sums(df, "v", ["g"]).collect()}
    assert got == {"up": (None, "overflow"), "down": (None, "overflow"), "half": (None, "overflow"), "under": (top, None), "back": (2.5, None)}


@pytest.mark.parametrize("name", ["wide_range_sums", "sum_problems"])
def test_queries_match_sql(spark, name):
    want = duckdb.sql(star.SQL[name].replace("FROM lineitem", f"FROM '{SF}/lineitem.parquet'")).fetchall()
    assert sorted(map(tuple, star.QUERIES[name](spark, SF).collect()), key=str) == sorted(want, key=str)
