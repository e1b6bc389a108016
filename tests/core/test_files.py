"""Files whose number must not follow the rows, and readers that take text apart once."""

import os

import pytest
from cladeframe.operators.parts import read_manifest, read_parts, refresh_parts
from cladeframe.sources import tables
from pyspark.sql import functions as F


def held(folder):
    return [f"{d}/{n}" for d, _, names in os.walk(folder) for n in names if n.startswith("part-")]


def test_qc_files_share_a_folder(spark, tmp_path):
    # F7
    to = str(tmp_path / "qc")
    own = spark.range(50).select(F.col("id").cast("string").alias("species"), F.concat(F.lit("r"), "id").alias("run"), F.lit(1.5).alias("total_tpm"))
    tables.write_qc(own, to)
    assert len(held(to)) == 50 and not [x for x in os.scandir(to) if x.is_dir()]
    assert sorted(map(tuple, tables.read_qc(spark, to).select("species", "run", "total_tpm").collect())) == sorted(map(tuple, own.collect()))


def test_packed_parts(spark, tmp_path):
    # a run writes no more files than its rows need, and old rows are not read
    to = str(tmp_path / "mapping")
    line = spark.range(3000).select((F.col("id") % 300).cast("string").alias("sample"), "id")
    want = line.select("sample").distinct().withColumn("content", F.lit("a"))
    refresh_parts(spark, to, want, lambda keys: line.join(keys, "sample", "left_semi"), packed=True)
    first = held(f"{to}/rows")
    assert len(first) < 100 and os.listdir(f"{to}/rows") == ["part_version=1"]
    later = want.where("sample <> '7'").withColumn("content", F.when(F.col("sample") == "5", "b").when(F.col("sample") == "6", "none").otherwise("a"))
    build = lambda keys: line.where("id < 100 and sample <> '6'").join(keys, "sample", "left_semi")
    out = refresh_parts(spark, to, later, build, packed=True)
    assert sorted(map(tuple, out.where("sample in ('5', '6', '7', '8')").collect())) == [("5", "b", 1, 2), ("6", "none", 0, 2), ("8", "a", 10, 1)]
    assert set(first) < set(held(f"{to}/rows"))
    counts = {r.sample: r["count"] for r in read_parts(spark, to, packed=True).groupBy("sample").count().collect()}
    assert len(counts) == 298 and counts["5"] == 1 and counts["8"] == 10 and "6" not in counts and "7" not in counts
    # rows that a broken run leaves are no part
    with pytest.raises(Exception, match="broken"):
        refresh_parts(spark, to, later.withColumn("content", F.lit("c")), lambda keys: keys.withColumn("id", F.raise_error(F.lit("broken")).cast("long")), packed=True)
    assert read_manifest(spark, to)[1] == 2 and read_parts(spark, to, packed=True).count() == 297 * 10 + 1


def test_search_detail_is_read_and_shuffled_once(spark, tmp_path):
    # F12
    to = tmp_path / "detail"
    rows = ["# a note", "*\tg1\tK1\t25\t30.5\t1e-5\tx", "*\tg1\tK1\t25\t30.5\t1e-5\ty", "\tg1\tK2\t-\t5\t1e-5\tx", "\tg2\tK1\t25\t5\t1e-5\tx", "*\tg2\tK1\t25\t29\t1e-5\tx", "\tg3\tK1\t25\t30\t1e999\tx", "\t\tK1\t25\t5\t1e-5\tx"]
    to.write_text("\n".join(rows) + "\n")
    out = tables.read_search_detail(spark, str(to))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange ") == 1
    assert sorted(tuple(r) for r in out.where("problem is null or problem <> 'conflict'").collect()) == [("g1", "K1", 30.5, 25.0, 1e-5, True, "accepted", None), ("g1", "K2", 5.0, None, 1e-5, False, "threshold_missing", None), ("g3", "K1", 30.0, 25.0, None, False, "below_threshold", "mark")]
    assert out.where("problem = 'conflict'").count() == 2 and out.count() == 5


def test_outgroup_edges_count_tips_once(spark, tmp_path, monkeypatch):
    # whether a tree is rooted follows from the counts that its edge has
    from cladeframe.operators import forest as O
    from cladeframe.sources.newick import forest

    nodes = forest(spark.createDataFrame([("t", "((a:1,b:1):1,(c:1,d:1):1);"), ("u", "(((a:1,b:1):1,c:1):1,d:1);"), ("v", "(c:1,d:1);")], "tree_id string, newick string")).persist()
    group = spark.createDataFrame([("a",), ("b",)], "tip string")
    made, hits = [], O._hits
    monkeypatch.setattr(O, "_hits", lambda *a: made.append(1) or hits(*a))
    out = O.outgroup_edges(nodes, group)
    assert len(made) == 1
    assert sorted((r.tree_id, r.rooted, r.problem) for r in out.collect()) == [("t", True, None), ("u", False, None), ("v", False, "no_outgroup")]
