import os

import pytest
from cladeframe.operators import forest as O
from cladeframe.operators import markers as M
from cladeframe.operators import selection as S
from cladeframe.operators.parts import read_manifest, read_parts, refresh_parts
from cladeframe.sources.newick import forest
from pyspark.sql import functions as F


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def files(folder):
    return {name for d, _, names in os.walk(f"{folder}/rows") for name in (f"{d}/{n}" for n in names) if "part-" in name}


def test_only_changed_parts_are_written(spark, tmp_path):
    to, asked = str(tmp_path / "mapping"), []
    genes = spark.createDataFrame([("001", "g1"), ("001", "g2"), ("2", "g3"), ("3", "g4")], "sample string, gene string")

    def build(keys):
        asked.append(sorted(r.sample for r in keys.collect()))
        return genes.join(keys, "sample", "left_semi")

    want = lambda *x: spark.createDataFrame(list(x), "sample string, content string")
    assert rows(refresh_parts(spark, to, want(("001", "a"), ("2", "b"), ("3", "c"), ("4", "d")), build), "sample", "content", "rows", "version") == [("001", "a", 2, 1), ("2", "b", 1, 1), ("3", "c", 1, 1), ("4", "d", 0, 1)]
    before = files(to)
    # one changed, one gone, the others as they were
    out = refresh_parts(spark, to, want(("001", "a"), ("2", "new"), ("4", "d")), build)
    assert rows(out, "sample", "content", "rows", "version") == [("001", "a", 2, 1), ("2", "new", 1, 2), ("4", "d", 0, 1)]
    assert asked == [["001", "2", "3", "4"], ["2"]]
    assert {f for f in before if "sample=2/" not in f} == {f for f in files(to) if "sample=2/" not in f} and before != files(to)
    assert rows(read_parts(spark, to), "sample", "gene") == [("001", "g1"), ("001", "g2"), ("2", "g3")]
    # nothing to do; then a key whose new content gives no rows
    assert rows(refresh_parts(spark, to, want(("001", "a"), ("2", "new")), build), "sample", "version") == [("001", 1), ("2", 2)] and asked[-1] == []
    refresh_parts(spark, to, want(("001", "a"), ("2", "none")), lambda keys: genes.where("false").join(keys, "sample", "left_semi"))
    assert rows(read_manifest(spark, to)[0], "sample", "rows", "version") == [("001", 2, 1), ("2", 0, 4)] and rows(read_parts(spark, to), "sample") == [("001",), ("001",)]


def test_a_broken_run_leaves_the_last_manifest(spark, tmp_path):
    to = str(tmp_path / "mapping")
    one = spark.createDataFrame([("s", "a")], "sample string, content string")
    refresh_parts(spark, to, one, lambda keys: keys.withColumn("gene", F.lit("g")))
    with pytest.raises(Exception, match="broken"):
        refresh_parts(spark, to, one.withColumn("content", F.lit("b")), lambda keys: keys.withColumn("gene", F.raise_error(F.lit("broken")).cast("string")))
    assert rows(read_manifest(spark, to)[0], "sample", "content", "version") == [("s", "a", 1)] and rows(read_parts(spark, to), "gene") == [("g",)]
    with pytest.raises(ValueError):
        refresh_parts(spark, to, spark.createDataFrame([(None, "a")], "sample string, content string"), lambda keys: keys)
    with pytest.raises(ValueError):
        read_parts(spark, str(tmp_path / "nothing"))


def test_pairs_of_representatives(spark):
    """Two clades of several tips meet; the best-scored tip of each stands for it, w has no trait, z's clade is in no pair."""
    nodes = forest(spark.createDataFrame([("t", "(((a:1,(b:1,w:1):1):1,(c:1,d:1):1):1,(e:1,(f:1,z:1):1):1);"), ("u", "(a:1,c:1);")], "tree_id string, newick string")).persist()
    traits = spark.createDataFrame([("a", "0"), ("b", "0"), ("c", "1"), ("d", "1"), ("e", "1"), ("f", "1"), ("z", "1"), ("w", None)], "tip string, trait string")
    scores = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 5.0), ("d", None), ("e", 1.0)], "tip string, score double")
    out = O.representative_pairs(nodes, traits, scores)
    pair = {(r.tree_id, r.tip): (r.representative, r.pair_id, r.reason) for r in out.collect()}
    assert pair["t", "a"] == pair["t", "b"] == ("b", 1, None) and pair["t", "c"] == pair["t", "d"] == ("c", 1, None)
    assert pair["t", "w"] == (None, None, "no_trait") and pair["t", "z"] == pair["t", "f"] == pair["t", "e"] == ("e", None, "unpaired")
    assert pair["u", "a"] == ("a", 1, None) and pair["u", "c"] == ("c", 1, None) and len(pair) == 10
    tied = scores.withColumn("score", F.lit(1.0))
    stood = {seed: {r.representative for r in O.representative_pairs(nodes, traits, tied, seed=seed).where("tree_id = 't' and tip = 'a'").collect()} for seed in range(8)}
    assert set.union(*stood.values()) == {"a", "b"}


def test_summary_of_gene_trees(spark):
    trees = spark.createDataFrame([("m1", "retained", 100), ("m2", "retained", 50), ("m3", "too_few", 9)], "tree_id string, status string, sites long")
    tips = spark.createDataFrame([("m1", "A"), ("m1", "B"), ("m2", "A"), ("m3", "C")], "tree_id string, sample string")
    samples = lambda *x: spark.createDataFrame([(s,) for s in x], "sample string")
    cols = ("retained", "excluded", "total_sites", "mean_sites", "samples", "unrepresented", "unexpected", "status")
    assert rows(M.gene_tree_summary(trees, tips, samples("A", "B", "C")), *cols) == [(2, 1, 150, 75.0, 3, 1, 0, "insufficient_coverage")]
    assert rows(M.gene_tree_summary(trees, tips, samples("A", "B")), *cols) == [(2, 1, 150, 75.0, 2, 0, 0, "retained")]
    assert rows(M.gene_tree_summary(trees.where("false"), tips, samples("A")), *cols) == [(0, 0, 0, 0.0, 1, 1, 0, "insufficient_coverage")]
    assert rows(M.unrepresented(tips, samples("A", "D")), "sample") == [("D",)]


def test_best_of_a_key(spark):
    df = spark.createDataFrame([("k", 1.0, "b", False), ("k", 1.0, "a", False), ("k", None, "c", False), ("l", None, "z", None), ("l", None, "y", True), ("m", 9.0, "x", False), ("m", -1.0, "w", True)], "k string, v double, t string, f boolean")
    assert rows(S.best_per_key(df, "k", "v", "t"), "k", "t") == [("k", "a"), ("l", "y"), ("m", "x")]
    assert rows(S.best_per_key(df, "k", "v", "t", first="f"), "k", "t") == [("k", "a"), ("l", "y"), ("m", "w")]
