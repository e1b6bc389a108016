import pytest
from cladeframe.operators.subset import Node, cut_graph, dropped_in_graph, evaluation_order, graph_problems, write_graph
from cladeframe.sources.newick import forest


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def graph(spark):
    """Five samples with six runs; one alignment belongs to the first sample only, and so does one tree but for a tip."""
    make = spark.createDataFrame
    samples = make([("Sa", "0"), ("Sb", "1"), ("Sc", "0"), ("Sd", "1"), ("Se", None)], "sample string, trait string").selectExpr("*", "sample AS tip")
    runs = make([("R0", "Sa"), ("R1", "Sb"), ("R2", "Sc"), ("R3", "Sd"), ("R4", "Se"), ("R5", "Sa")], "run string, sample string")
    long = make([(f"R{i}", f"g{k}", float(k)) for i in range(6) for k in range(2)], "run string, gene string, tpm double")
    wide = make([(f"R{i}", "0", None) for i in range(6)], "run string, K1 string, K2 string")
    align = make([("OGboth", "Sa", "AC-T"), ("OGboth", "Sb", "ACGT"), ("OGonly", "Sa", "TTTT")], "og string, sample string, seq string")
    trees = forest(make([("t", "(((Sa:1,Sb:2):1,(Sc:1,Sd:1):2):1,Se:3);"), ("u", "(Sa:1,Sb:1);")], "tree_id string, newick string"))
    pairs = make([("t", "stale", "Sa"), ("t", "stale", "Sb")], "tree_id string, pair_id string, tip string")
    return {
        "pairs": Node(pairs, "pairs", parent="trees", traits="samples"), "wide": Node(wide, "rows", "run", "runs", "run", unique=True, complete=True),
        "long": Node(long, "rows", "run", "runs", "run"), "runs": Node(runs, "rows", "sample", "samples"), "trees": Node(trees, "forest", parent="samples", parent_key="tip"),
        "alignments": Node(align, "groups", "sample", "samples", group="og"), "labels": Node(make([("K1", "x")], "ko string, name string"), "whole"), "samples": Node(samples, "keep"),
    }


def keep(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "sample string")


def test_cut(spark, graph):
    wanted = keep(spark, "Sb", "Sc", "Sd", "Se")
    out = cut_graph(graph, wanted)
    assert rows(out["runs"], "run") == [("R1",), ("R2",), ("R3",), ("R4",)]
    assert rows(out["long"], "run", "gene", "tpm") == sorted((f"R{i}", f"g{k}", float(k)) for i in (1, 2, 3, 4) for k in range(2))
    assert rows(out["wide"], "run", "K1", "K2") == [(f"R{i}", "0", None) for i in (1, 2, 3, 4)]
    assert rows(out["alignments"], "og", "seq") == [("OGboth", "ACGT")]
    assert rows(dropped_in_graph(graph, out), "table", "group") == [("alignments", "OGonly"), ("trees", "u")]
    assert rows(out["trees"].where("name is not null"), "name", "dist") == [("Sb", 3.0), ("Sc", 1.0), ("Sd", 1.0), ("Se", 3.0)]
    assert out["labels"].count() == 1
    # the pair of Sa and Sb is gone with Sa, that of Sc and Sd is found anew, and no stale id is left
    assert rows(out["pairs"], "tree_id", "pair_id", "zero", "one", "resolved") == [("t", 1, 1, 1, True)]


def test_written_counts(spark, graph, tmp_path):
    out, report = write_graph(graph, keep(spark, "Sb", "Sc", "Sd", "Se"), folder=str(tmp_path / "out"))
    want = [("alignments", "groups", 3, 1, 0), ("labels", "whole", 1, 1, 0), ("long", "rows", 12, 8, 0), ("pairs", "pairs", 2, 1, 0), ("runs", "rows", 6, 4, 0), ("samples", "keep", 5, 4, 0), ("trees", "forest", 12, 7, 0), ("wide", "rows", 6, 4, 0)]
    assert rows(report, "table", "rule", "rows_before", "rows_after", "orphans") == want
    assert {n: df.count() for n, df in out.items()} == {w[0]: w[3] for w in want}


def test_problems(spark, graph):
    assert graph_problems(graph, keep(spark, "Sa")).count() == 0
    bad = dict(graph)
    bad["long"] = Node(spark.createDataFrame([("R0", "g"), ("R9", "g")], "run string, gene string"), "rows", "run", "runs", "run")
    bad["wide"] = Node(spark.createDataFrame([(f"R{i % 5}",) for i in range(6)], "run string"), "rows", "run", "runs", "run", unique=True, complete=True)
    bad["trees"] = Node(forest(spark.createDataFrame([("t", "(Sa:1,Zz:1);")], "tree_id string, newick string")), "forest", parent="samples", parent_key="tip")
    got = rows(graph_problems(bad, keep(spark, "Sa", "Sx")), "table", "problem", "key")
    assert got == [("long", "orphan", "R9"), ("samples", "unknown", "Sx"), ("trees", "orphan", "Zz"), ("wide", "missing", "R5"), ("wide", "repeated", "R0")]


def test_order(spark, graph):
    order = evaluation_order(graph)
    assert all(order.index(n) > order.index(x) for n, node in graph.items() for x in (node.parent, node.traits) if x)
    with pytest.raises(ValueError, match="circle"):
        evaluation_order({"a": Node(graph["long"].df, "rows", "run", "b", "run"), "b": Node(graph["long"].df, "rows", "run", "a", "run")})
    for node in (Node(graph["long"].df, "rows", "run", "nowhere"), Node(graph["long"].df, "odd"), Node(graph["long"].df, "rows")):
        with pytest.raises(ValueError):
            evaluation_order({"a": node})
