import math
import random

import pytest
from cladeframe.functions.text import exact
from cladeframe.operators import forest as O
from cladeframe.operators import taxonomy as X
from cladeframe.operators.sums import exact_sums
from cladeframe.operators.votes import vote_summary
from cladeframe.sources.newick import forest
from pyspark.sql import functions as F


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_sums_are_the_nearest_doubles(spark):
    rng = random.Random(11)
    groups = {
        "cancel": [1e21, 1e-19, -1e21], "tiny": [5e-324] * 3, "half": [1.0, 2**-53], "above half": [1.0, 2**-53, 2**-1074], "odd half": [1.0 + 2**-52, 2**-53], "negative": [-1e308, -7.25, 1e308], "none": [None, None], "zero": [0.0, -0.0],
        "high": [1.7e308, -1.7e308, 1.5], "subnormal": [2.2250738585072014e-308, -1.1e-308], "power": [2.0**64, -(2.0**64) + 2.0**12], "edge": [2.0**32, 2.0**-32, 4294967295.0], "largest": [1.7976931348623157e308],
        **{f"r{k}": [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-300, 300) for _ in range(40)] for k in range(60)}, **{f"s{k}": [rng.uniform(-1, 1) for _ in range(100)] for k in range(20)},
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    for parts in (1, 7):
        got = {r.g: (r.total, r.problem) for r in exact_sums(df.repartition(parts), "v", ["g"]).collect()}
        for g, vs in groups.items():
            assert got[g] == (math.fsum(v for v in vs if v is not None), None), g


def test_values_that_are_no_finite_numbers(spark):
    df = spark.createDataFrame([("a", "nan"), ("a", "1"), ("b", "inf"), ("c", "word"), ("d", "1.7e308"), ("d", "1.7e308"), ("e", "1e400"), ("f", "2"), ("f", None), (None, "3")], "g string, v string")
    assert rows(exact_sums(df, "v", ["g"]), "g", "total", "problem") == sorted([("a", None, "not_finite"), ("b", None, "not_finite"), ("c", None, "not_finite"), ("d", None, "overflow"), ("e", None, "not_finite"), ("f", 2.0, None), (None, 3.0, None)], key=str)


def test_exact_never_loses_a_number(spark):
    ok = spark.createDataFrame([("0.1",), ("-3e-18",), ("9e19",), ("0",), ("x",), (None,)], "v string")
    assert rows(ok.select(exact(F.col("v")).cast("double").alias("d")), "d") == sorted([(0.1,), (-3e-18,), (9e19,), (0.0,), (None,), (None,)], key=str)
    for bad in ("1e21", "1e-19"):
        with pytest.raises(Exception, match="no exact decimal"):
            spark.createDataFrame([(bad,)], "v string").select(exact(F.col("v"))).collect()


def test_long_redirects(spark):
    """Chains of 25 and 1,000 hops, a circle, a way into a circle, an end that is no node."""
    links = [(i, i + 1) for i in range(100, 125)] + [(i, i + 1) for i in range(2000, 3000)] + [(7, 8), (8, 9), (9, 7), (6, 7), (50, 51)]
    merged = spark.createDataFrame(links, "taxid_old long, taxid_new long")
    nodes = spark.createDataFrame([(125,), (3000,), (1,)], "taxid long")
    ids = spark.createDataFrame([(100,), (2000,), (2999,), (7,), (6,), (50,), (1,), (4,)], "taxid long")
    want = [(100, 125, None), (2000, 3000, None), (2999, 3000, None), (7, None, "cycle"), (6, None, "cycle"), (50, None, "unknown"), (1, 1, None), (4, None, "unknown")]
    assert rows(X.resolve_merged(ids, merged, nodes), "taxid", "resolved_taxid", "reason") == sorted(want, key=str)


def test_lineages_end_at_the_root_or_are_named(spark):
    long = [(i, i - 1, "r", str(i)) for i in range(2, 301)]
    nodes = spark.createDataFrame([(1, 1, "root", "1"), *long, (1004, 999, "r", "x"), (1005, 1004, "r", "x"), (2001, 2002, "r", "x"), (2002, 2001, "r", "x"), (2003, 2001, "r", "x")], "taxid long, parent long, rank string, name string")
    ids = spark.createDataFrame([(300,), (1,), (1005,), (1004,), (2003,), (77777,)], "taxid long")
    assert rows(X.lineage_problems(nodes, ids), "taxid", "problem") == [(1004, "incomplete"), (1005, "incomplete"), (2003, "cycle"), (77777, "unknown")]
    with pytest.raises(ValueError, match="no whole lineage"):
        X.lineages(nodes, ids)
    got = X.lineages(nodes, ids, strict=False)
    assert rows(got, "taxid", "depth", "anc") == sorted([(300, d, 300 - d) for d in range(300)] + [(1, 0, 1)], key=str)


def test_large_ties_have_exact_shares(spark):
    """Ties of 17 and of 40, and a tie that also holds the registered taxon."""
    taxa = [f"t{i:02}" for i in range(40)]
    votes = [("r", "genus", f"a{i}", "alternative", taxa[:17]) for i in range(17)] + [("r", "genus", f"b{i}", "alternative", taxa) for i in range(40)] + [("r", "genus", "c", "tie", ["t00", "t01"]), ("r", "genus", "d", "registered", None)]
    out = vote_summary(spark.createDataFrame(votes, "run string, rank string, locus string, vote string, winners array<string>"), 5, "0.5").first()
    assert (out.alternative, out.status, out.comparable_loci) == ("t00", "discordant", 59)
    assert out.alternative_votes == pytest.approx(2 + 1 / 3, rel=1e-15) and out.registered_votes == pytest.approx(4 / 3, rel=1e-15)
    assert out.alternative_counts["t16"] == 2.0 and out.alternative_counts["t39"] == 1.0
    # three ties of three give one whole vote: just not under the cut
    even = [("q", "genus", f"a{i}", "tie", ["x", "y"]) for i in range(3)] + [("q", "genus", "b", "alternative", ["x"])]
    got = vote_summary(spark.createDataFrame(even, "run string, rank string, locus string, vote string, winners array<string>"), 1, "0.25").first()
    assert got.status == "no_discordance" and got.registered_votes == 1.0


def distances(tree):
    """{(a, b): length} between the tips of a tree (parent, length by node)."""
    out = {}
    for a in tree["tips"]:
        way, x, d = {}, a, 0.0
        while x is not None:
            way[x] = d
            d, x = d + (tree["dist"][x] or 0), tree["parent"][x]
        for b in tree["tips"]:
            x, d = b, 0.0
            while x not in way:
                d, x = d + (tree["dist"][x] or 0), tree["parent"][x]
            out[tree["tips"][a], tree["tips"][b]] = round(d + way[x], 9)
    return out


def plain(df):
    found = df.collect()
    inner = {r.parent_id for r in found}
    return {"parent": {r.node_id: r.parent_id for r in found}, "dist": {r.node_id: r.dist for r in found}, "tips": {r.node_id: r.name for r in found if r.node_id not in inner}}


@pytest.mark.parametrize("text,out", [
    ("((A:1,B:2)0.9:3,(C:4,(D:5,E:6)0.8:7)0.7:8);", "DE"), ("((A:1,B:2)0.9:3,(C:4,(D:5,E:6)0.8:7)0.7:8);", "AB"), ("((A:1,B:2)0.9:3,(C:4,(D:5,E:6)0.8:7)0.7:8);", "C"),
    ("((A:1,B:2):3,C:4,D:5);", "C"), ("(((A:1,B:1):1,C:2):1,(D:1,E:1):2,F:9);", "AB"), ("((A:1,B:2):3,C:4,D:5);", "CD"), ("(((((A:1,B:1):1,C:1):1,D:1):1,E:1):1,F:1);", "A"),
])
def test_rerooting(spark, text, out):
    nodes = forest(spark.createDataFrame([("t", text)], "tree_id string, newick string"))
    group = spark.createDataFrame([(x,) for x in out], "tip string")
    turned = O.rerooted(nodes, group).persist()
    assert rows(O.root_check(turned, group), "rooted") == [(True,)]
    assert distances(plain(turned)) == distances(plain(nodes))
    assert turned.groupBy("parent_id").count().where("parent_id is not null and count < 2").count() == 0
    below = {}
    for r in O.clade_tips(turned).collect():
        below.setdefault(r.node_id, set()).add(r.tip)
    tree = plain(turned)
    for x, up in tree["parent"].items():
        assert up is None or below[x] < below[up]
    depth = {r.node_id: r.depth for r in turned.collect()}
    assert all(up is None and depth[x] == 0 or depth[x] == depth[up] + 1 for x, up in tree["parent"].items())
    assert {round(r.distance, 9) for r in O.root_distances(turned).collect()} == {round(d, 9) for d in _from_root(tree)}


def _from_root(tree):
    for a in tree["tips"]:
        x, d = a, 0.0
        while x is not None:
            d, x = d + (tree["dist"][x] or 0), tree["parent"][x]
        yield d


def test_outgroups_that_root_nothing(spark):
    nodes = forest(spark.createDataFrame([("t", "((A,B),(C,D));")], "tree_id string, newick string"))
    group = lambda names: spark.createDataFrame([(x,) for x in names], "tip string")
    for names, problem in (("AC", "not_monophyletic"), ("X", "no_outgroup"), ("ABCD", "no_ingroup")):
        assert rows(O.outgroup_edges(nodes, group(names)), "problem") == [(problem,)] and O.rerooted(nodes, group(names)).count() == 0
    assert rows(O.outgroup_edges(nodes, group("AB")), "rooted", "problem") == [(True, None)]
