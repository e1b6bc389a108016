"""What keeps the driver and single tasks small on large tables."""

import pyarrow as pa

from cladeframe.operators import votes
from cladeframe.operators.store import stored, tasks_for
from cladeframe.plans import star
from cladeframe.sources import newick
from tests.conftest import SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_and_tips_are_not_broadcast(spark):
    a = stored(spark.range(1000).withColumnRenamed("id", "k"), "a")
    assert "Broadcast" not in plan(a.join(stored(spark.range(1000).withColumnRenamed("id", "k"), "b"), "k"))
    assert "Broadcast" not in plan(spark.range(10).selectExpr("cast(id as string) tip").join(star.tip_rows(spark, SF), "tip"))


def test_small_trees_share_a_batch_and_large_ones_are_cut():
    batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(9000)]), pa.array(["(a,b);"] * 9000)], ["tree_id", "newick"])
    sizes = [b.num_rows for b in newick._parse(iter([batch]))]
    assert sum(sizes) == 27000 and len(sizes) <= 3
    comb = pa.RecordBatch.from_arrays([pa.array(["c"]), pa.array(["(" + ",".join(f"t{i}" for i in range(45000)) + ");"])], ["tree_id", "newick"])
    assert [b.num_rows for b in newick._parse(iter([comb]))] == [20000, 20000, 5001]
    assert list(newick._parse(iter([]))) == []


def test_tasks_follow_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert tasks_for(spark.range(10)) == cores and tasks_for(spark.range(1001), rows=50) == 21
    a, m = star.abundance(spark, SF), star.brands(spark, SF)
    assert "REPARTITION_BY_NUM" in plan(a) and "REPARTITION_BY_NUM" in plan(m) and "Broadcast" not in plan(m)


def test_whole_labels_and_named_representatives(spark):
    # every label of every group, as the query's first SQL had it; F4: who is the best, not only how good
    assert star.all_labels(spark, SF.replace("0.001", "0.1")).groupBy("orthogroup").count().where("count > 2").count() > 0
    assert "p_size = 1" in star.SQL["function_expression_duplicate"] and "p_size = 1" not in star.SQL["function_expression_drop"]
    best = star.clade_representatives(spark, SF)
    assert best.columns == ["clade", "name", "score"]
    own = star.read(spark, SF, "customer")
    assert best.join(own, (best.name == own.c_custkey) & (best.score == own.c_acctbal) & (best.clade == own.c_nationkey)).count() == best.count()


def test_votes_shuffle_numbers_not_structs(spark):
    kinds = "run string, rank string, locus string, length int, registered string, taxon string, score int, matched array<struct<pos:int,ok:boolean>>"
    places = [(i, i % 2 == 0) for i in range(150)]
    hits = spark.createDataFrame([("r", "genus", "l", 150, "A", "A", 1, places), ("r", "genus", "l", 150, "A", "B", 1, places + [(900, True)])], kinds)
    out = votes.locus_votes(hits)
    assert ", good, " in out._jdf.queryExecution().analyzed().toString()
    assert [tuple(r) for r in out.collect()] == [("r", "genus", "l", "tie", ["B"], 150, 75, 75)]
