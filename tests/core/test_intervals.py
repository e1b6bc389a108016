import random

from cladeframe.operators import intervals as I
from pyspark.sql import functions as F


def test_positions(spark):
    """Two trees, one over many bins, against loops."""
    rng = random.Random(3)
    rows = [(t, i, rng.randrange(9), rng.choice("abcdefg") if rng.random() < 0.4 else None) for t, n in (("x", 9000), ("y", 5)) for i in range(n)]
    df = spark.createDataFrame(rows, "tree_id string, at long, v int, s string").repartition(5)
    sums = {(r.tree_id, r.at): r.total for r in I.prefix_sums(df, {"total": F.col("v")}).collect()}
    back = {(r.tree_id, r.at): r.near for r in I.nearest(df, F.col("s")).collect()}
    on = {(r.tree_id, r.at): r.near for r in I.nearest(df, F.col("s"), after=True).collect()}
    same = {(r.tree_id, r.at): r.before for r in I.previous_equal(df.where("s is not null"), "s").collect()}
    for t in "xy":
        own = [r for r in rows if r[0] == t]
        total, last, seen = 0, None, {}
        for _, i, v, s in own:
            total, last = total + v, s or last
            assert sums[t, i] == total and back[t, i] == last
            if s:
                assert same[t, i] == seen.get(s)
                seen[s] = i
        last = None
        for _, i, _, s in reversed(own):
            last = s or last
            assert on[t, i] == last


def test_least_between(spark):
    rng = random.Random(4)
    values = {"x": [rng.randrange(50) for _ in range(3000)], "y": [2, 1, 1]}
    points = spark.createDataFrame([(t, i, v) for t, vs in values.items() for i, v in enumerate(vs)], "tree_id string, at long, v int")
    asked = [("x", *sorted(rng.choices(range(3000), k=2))) for _ in range(300)] + [("x", i, min(2999, i + k)) for i in range(0, 2999, 251) for k in (0, 1, 5, 256, 300)] + [("y", 0, 2), ("y", 2, 2), ("x", 0, 2999)]
    out = I.least_between(points, spark.createDataFrame(sorted(set(asked)), "tree_id string, lo long, hi long")).collect()
    assert len(out) == len(set(asked))
    for r in out:
        part = values[r.tree_id][r.lo : r.hi + 1]
        assert r.least == r.lo + part.index(min(part))
