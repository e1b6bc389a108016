"""Operators on small literal tables."""

import gzip

import pytest
from cladeframe.functions import text as T
from cladeframe.operators import annotation as A
from cladeframe.operators import checks as C
from cladeframe.operators import expression as E
from cladeframe.operators import identity as I
from cladeframe.operators import mapping as M
from cladeframe.operators import markers as K
from cladeframe.operators import selection as S
from cladeframe.operators import taxonomy as X
from cladeframe.operators import votes as V
from cladeframe.sources import tables as R
from pyspark.sql import functions as F


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_text_functions(spark):
    lit = F.lit
    assert [one(spark, T.is_safe(lit(x))) for x in ("a.b-c_1", "-a", "a b", "a\n", "")] == [True, False, False, False, False]
    assert one(spark, T.sample_of_gene(lit("Plant_A_R_1_g12"))) == "Plant_A_R_1" and one(spark, T.sample_of_gene(lit("x_g1\n"))) is None
    assert one(spark, T.clean_scientific_name(lit("[Genus]  sp, a/b"))) == "Genus sp a-b" and one(spark, T.clean_scientific_name(lit("Alga"))) == "Alga_XXX"
    assert [one(spark, T.canonical_taxid(lit(x))) for x in ("42", "42.0", "", "0", "4.5")] == [42, 42, None, None, None]
    assert [one(spark, T.number(lit(x))) for x in ("2e1", "1d", "-1", "inf", "NaN", " 3 ", "1_0")] == [20.0, None, None, None, None, 3.0, None]
    total = lambda n: lit(n).cast("long")
    for fraction, n, want in (("0", 5582, 0), ("0.5", 5582, 2791), ("0.5", 3, 2), ("0.07", 100, 7), ("0.14", 100, 14), ("1", 3, 3)):
        assert one(spark, T.decimal_ceiling(fraction, total(n))) == want
    assert one(spark, T.reverse_complement(lit("ACCGTN"))) == "NACGGT"
    assert one(spark, T.translated(lit("ATGAAATAA"))) == "MK*" and one(spark, T.translated(lit("ATGNAATAAAT"), to_stop=True)) == "MX"
    assert one(spark, T.translated(lit("AT"))) == ""
    assert [one(spark, T.normalized_protein(lit(x))) for x in ("MK*", "MK*K", "*", "mk")] == ["MK", None, None, None]
    assert [one(spark, T.sequence_problem(lit(x), 3, 0.5)) for x in ("MK", "MKLXXXX", "MKLV")] == ["short_protein", "ambiguous_protein", None]
    assert one(spark, T.accessions(lit("err1, SRR22 and ERR1"))) == ["ERR1", "SRR22"]
    assert one(spark, T.header_words(lit("name a:1 b:2"))) == {"a": "1", "b": "2"}
    assert tuple(one(spark, T.label_parts(lit("O_F_G_rest_of_it")))) == ("O", "F", "G", "rest_of_it")
    assert [tuple(x) for x in one(spark, T.aligned_positions(lit("2M1I1M1D1M"), lit(0), lit(5)))] == [(0, 5), (1, 6), (3, 7), (4, 9)]
    assert one(spark, T.aligned_columns(lit("ACDE"), F.array(lit(0), lit(2)))) == "AD"
    assert one(spark, T.percent(lit(1), lit(3))) == "33.33" and one(spark, T.unknown_as_gap(lit("AX?"))) == "A--"


def test_checks(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1)], "k string, v int")
    b = spark.createDataFrame([("x", 1), ("z", 1)], "k string, v int")
    assert rows(C.check_unique(a, ["k"]), "k", "n") == [("x", 2)]
    assert rows(C.check_functional(a, ["k"], "v"), "k") == [("x",)]
    assert rows(C.check_coverage(a, b, ["k"]), "k", "side") == [("y", "extra"), ("z", "missing")]
    assert rows(C.check_allowed(a, "k", ["x"]), "k") == [("y",)]
    assert rows(C.check_disjoint(a, b, ["k"]), "k") == [("x",)]
    C.require(C.check_foreign_key(a, a, ["k"]))
    with pytest.raises(C.CheckFailed):
        C.require(C.check_foreign_key(a, b, ["k"]))
    t = spark.createDataFrame([("A", "A_g1", "1"), ("A", "A_g1", "2"), ("A", "B_g1", "x")], "sample string, gene_id string, tpm string")
    found = rows(C.check_expression(t, spark.createDataFrame([("A",), ("Q",)], "sample string")), "rule", "detail")
    assert found == sorted([("bad value", "B_g1"), ("foreign gene", "B_g1"), ("repeated", "A_g1"), ("missing sample", None)], key=str)


def test_identity(spark):
    s = spark.createDataFrame([("Beta sp-X", "B1", None), ("Alpha plant", "A1", "wrong")], "scientific_name string, run string, species_id string")
    assert rows(I.annotate_samples(s), "analysis_sample_id", "odb_species", "conflict") == [("Alpha_plant_A1", "Alpha_plant_A1", "species_id"), ("Beta_sp-X_B1", "Beta_sp_X_B1", None)]
    traits = spark.createDataFrame([("Plant A", "0"), ("Plant B-x", " 1 "), ("C", "NA"), ("D", "2")], "species string, t string")
    assert rows(I.normalize_traits(traits, "t"), "species_id", "t", "bad") == [("C", None, False), ("D", "2", True), ("Plant_A", "0", False), ("Plant_B-x", "1", False)]
    g = spark.createDataFrame([("Old_1_g7", "Old_1_g7"), ("Other_g1", "x")], "gene_id string, note string")
    names = spark.createDataFrame([("Old_1", "New")], "old string, new string")
    assert rows(I.relabel_genes(g, names), "gene_id", "note") == [("New_g7", "Old_1_g7"), ("Other_g1", "x")]
    m = spark.createDataFrame([("S", "S_1"), ("S", "S_2"), ("T", "T_1")], "species_id string, sample string")
    q = spark.createDataFrame([("S",), ("T_1",), ("no",)], "selector string")
    assert rows(I.expand_selectors(m, q), "sample") == [("S_1",), ("S_2",), ("T_1",)] and rows(I.unknown_selectors(m, q), "selector") == [("no",)]
    e = spark.createDataFrame([("a", "a"), ("a", "b"), ("", "b")], "x string, y string")
    assert sorted(r.evidence for r in I.read_evidence(e, "x", "y").collect()) == ["a", "mixed", "unknown"]
    alias = spark.createDataFrame([("1", None), ("1", "2")], "new string, old string")
    assert rows(I.coalesce_aliases(alias, {"new": "old"}), "new", "conflict") == [("1", "new"), ("1", None)]


def test_selection(spark):
    c = spark.createDataFrame([("a", 8, 1, 1, 0, 10), ("b", 5, 1, 1, 0, 10)], "sample string, single int, duplicated int, fragmented int, missing int, total int")
    meta = spark.createDataFrame([("a",), ("b",), ("n",)], "sample string")
    assert rows(S.select_complete(meta, c, "sample", 0.0), "sample", "completeness", "selected") == [("a", 0.9, True), ("b", None, False), ("n", None, False)]
    best = spark.createDataFrame([(1, "r2", 5.0), (1, "r1", 5.0), (1, "r0", 4.0), (2, "q", None)], "taxid int, run string, bases double")
    assert rows(S.best_per_key(best, "taxid", "bases", "run"), "taxid", "run") == [(1, "r1"), (2, "q")]
    one_per = lambda *x: spark.createDataFrame(list(x), "taxid int, run string")
    out = S.refresh_decisions(one_per((1, "a"), (2, "b"), (3, "c"), (6, "f")), one_per((1, "a")), one_per((2, "b"), (3, "d"), (4, "e"), (7, "g")), one_per((5, "o"), (7, "h")))
    assert rows(out, "taxid", "run", "decision") == [(1, "a", "retained"), (2, "b", "reselected"), (3, "d", "replacement"), (4, "e", "new"), (5, "o", "override"), (6, None, "unresolved"), (7, "h", "override")]
    n = spark.createDataFrame([(i,) for i in range(11)], "i int")
    assert [r.i for r in S.evenly_spaced(n, ["i"], 4).orderBy("i").collect()] == [round(k * 10 / 3) for k in range(4)]
    assert S.evenly_spaced(n, ["i"], 20).count() == 11
    old, new = spark.createDataFrame([("k", "old")], "k string, r string"), spark.createDataFrame([("k", "x", 1), ("l", "y", 2)], "k string, r string, extra int")
    assert rows(S.append_new(old, new, "k"), "k", "r", "extra") == [("k", "old", None), ("l", "y", 2)]
    kept, gone = S.split_excluded(one_per((1, "a"), (2, "b")), spark.createDataFrame([("b", "")], "run string, reason string"), "run")
    assert rows(kept, "run") == [("a",)] and rows(gone, "run", "reason") == [("b", "manually excluded")]


GENES = [("g1", 20.0), ("g2", 30.0), ("g3", 10.0), ("g4", 10.0), ("g5", 10.0), ("g6", 10.0), ("g8", 0.0), ("g9", 10.0)]
HITS = [("g1", "K00001", "accepted"), ("g1", "K00009", "below_threshold"), ("g2", "K00001", "accepted"), ("g3", "K00002", "accepted"), ("g3", "K00003", "accepted"), ("g4", "K00004", "below_threshold"), ("g5", "K00005", "threshold_missing"), ("g7", "K00006", "accepted"), ("g8", "K00007", "accepted")]


def test_functions_of_genes(spark):
    tpm = spark.createDataFrame([("A1", g, v) for g, v in GENES], "sample string, gene_id string, tpm double")
    hits = spark.createDataFrame([("A1", *h) for h in HITS], "sample string, gene_id string, ko string, assignment_status string")
    drop = {r.ko: (r.tpm_sum, r.annotated_genes, r.quantified_genes) for r in A.gene_function_expression(tpm, hits).collect()}
    assert drop == {"K00001": (50.0, 2, 2), "K00006": (None, 1, 0), "K00007": (0.0, 1, 1)}
    both = {r.ko: r.tpm_sum for r in A.gene_function_expression(tpm, hits, "duplicate").collect()}
    assert both["K00002"] == both["K00003"] == 10.0
    genes = spark.createDataFrame([("A1", f"g{i}") for i in range(1, 9)], "sample string, gene_id string")
    status = A.hit_status(genes, hits)
    assert {r.gene_id: r.assignment_status for r in status.collect()} == {"g1": "unique", "g2": "unique", "g3": "ambiguous", "g4": "below_threshold", "g5": "threshold_missing", "g6": "unannotated", "g7": "unique", "g8": "unique"}
    part = {r.status: (r.genes, r.tpm) for r in A.status_partition(status.withColumn("sample", F.lit("A1")), tpm).collect()}
    assert part["unique"] == (4, 50.0) and part["no_protein"] == (0, 10.0)


def test_representatives(spark):
    data = {"A": {1: "AA", 2: "AXAA", 3: "MK*K", 4: "MK*", 5: "AAAA"}, "B": {1: "AAAA", 2: "AAAA", 3: "*"}, "C": {1: "AAAAAA", 2: "AAAA"}, "D": {1: "AAAAAAAAAA"}}
    df = spark.createDataFrame([(f"OG{n}", f"{s}_g{n}", q) for s, x in data.items() for n, q in x.items()], "orthogroup string, gene_id string, seq string")
    out = {r.orthogroup: r for r in A.representatives(df).collect()}
    assert (out["OG1"].representative, out["OG1"].length, out["OG1"].median_length) == ("C_g1", 6, 5.0)
    assert out["OG2"].representative == "B_g2" and (out["OG3"].status, out["OG3"].invalid_members) == ("no_valid_representative", 2)
    assert out["OG4"].length == 2
    valid = A.batch_labels(A.representatives(df).where("status = 'selected'"), "orthogroup", 2)
    assert rows(valid, "orthogroup", "batch") == [("OG1", "batch_00000"), ("OG2", "batch_00000"), ("OG4", "batch_00001"), ("OG5", "batch_00001")]


def test_group_expression(spark):
    tpm = spark.createDataFrame([("s", "s_g1", "20"), ("s", "s_g2", "30"), ("s", "s_g3", "50"), ("s", "s_g4", "0.0")], "sample string, gene_id string, tpm string")
    m = spark.createDataFrame([("s", "s_g1", "O1"), ("s", "s_g1", "O1"), ("s", "s_g2", "O2"), ("s", "s_g4", "O3"), ("s", "s_g3", None)], "sample string, gene_id string, orthogroup string")
    out = E.group_expression(tpm, m)
    assert rows(out, "orthogroup", "tpm_sum", "tpm") == [("O1", 20.0, 400000.0), ("O2", 30.0, 600000.0), ("O3", 0.0, 0.0)]
    assert E.renormalised_error(out).count() == 0
    q = E.expression_quality(tpm, m).first()
    assert (q.targets, q.mapped_targets, q.orthogroups, q.mapped_tpm_fraction) == (4, 3, 3, 0.5)
    assert E.wide(out, "sample", "orthogroup", "tpm_sum", ["O1", "O9"], 0.0).first().O9 == 0.0
    assert E.wide_map(out, "sample", "orthogroup", "tpm_sum").first()["values"] == {"O1": 20.0, "O2": 30.0, "O3": 0.0}
    s = spark.createDataFrame([("s", "s_g1", "1.2300"), ("s", "s_g2", "-0.0"), ("s", "s_g9", "02.500")], "sample string, gene_id string, tpm string")
    assert rows(E.sequence_table(s, m), "gene_id", "tpm_text", "groups") == [("s_g1", "1.2300", "O1"), ("s_g2", "-0.0", "O2"), ("s_g9", "02.500", None)]


def test_mapping(spark):
    g = spark.createDataFrame([("s", "g1"), ("s", "g2"), ("s", "g3")], "sample string, gene_id string")
    p = spark.createDataFrame([("s", "g1", "O1"), ("s", "g1", "O1"), ("s", "g1", "O2"), ("s", "g9", "O1")], "sample string, gene_id string, orthogroup string")
    assert rows(M.map_genes(g, p), "gene_id", "orthogroup") == sorted([("g1", "O1"), ("g1", "O2"), ("g2", None), ("g3", None)], key=str)
    assert rows(M.foreign_pairs(g, p), "gene_id") == [("g9",)]
    c = M.mapping_counts(g, p).first()
    assert (c.protein_genes, c.input_annotation_rows, c.unique_gene_og_pairs, c.duplicate_pairs_removed, c.ambiguous_genes) == (3, 4, 3, 1, 1)
    o = spark.createDataFrame([("a", "three"), ("b", "three"), ("c", "three"), ("a", "half"), ("b", "half"), ("a", "half"), ("a", "low")], "sample string, orthogroup string")
    every = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "sample string")
    assert rows(M.occupancy(o, "0.5", samples=every), "orthogroup", "samples", "selected") == [("half", 2, True), ("low", 1, False), ("three", 3, True)]
    w = spark.createDataFrame([("a", "h1"), ("b", "h2")], "sample string, sha256 string")
    snap = spark.createDataFrame([("a", "h1", 2, "late"), ("a", "h1", 1, "early"), ("b", "other", 1, "early")], "sample string, sha256 string, priority int, source string")
    assert rows(M.reuse_plan(w, snap), "sample", "action", "source") == [("a", "reuse", "early"), ("b", "missing", None)]


def test_markers(spark):
    full = spark.createDataFrame([("s", "1", "Complete", "x"), ("s", "2", "Duplicated", "y"), ("s", "2", "Duplicated", "z"), ("s", "3", "Missing", None), ("s", "4", "Complete", "w"), ("s", "5", "Complete", "w")], "sample string, marker string, status string, sequence string")
    c = K.completeness_counts(full).first()
    assert (c.single, c.duplicated, c.fragmented, c.missing, c.total, c.repeated) == (3, 1, 0, 1, 5, 0)
    assert rows(K.single_copy(full), "marker") == [("1",)]
    aln = spark.createDataFrame([("m", "AC-T"), ("m", "AC-T"), ("m", "GCAT"), ("m", "GCGT")], "marker string, seq string")
    a = K.alignment_sites(aln).first()
    assert (a.rows, a.columns, a.variable_sites, a.informative_sites) == (4, 4, 2, 1)
    hits = spark.createDataFrame([(f"s{i}", m, 100.0) for m, n in zip(("1", "2", "3", "4", "5", "6", "7"), (18, 15, 18, 30, 9, 30, 3)) for i in range(n)], "sample string, marker string, length double")
    samples = spark.createDataFrame([(f"s{i}", f"sp{i}") for i in range(30)], "sample string, species_id string")
    cover = K.marker_coverage(hits, hits.select("marker"), samples, "0.5")
    assert [r.marker for r in K.best_markers(cover).collect()] == ["4", "6", "1", "3", "2"]


def test_votes(spark):
    rows_ = [("r", "genus", "registered", None)] * 5 + [("r", "genus", "alternative", ["20", "30"])] * 45
    one_ = [("q", "genus", "alternative", ["20", "30"])] * 31 + [("q", "genus", "alternative", ["20"])] * 9 + [("q", "genus", "tie", ["20"])] * 9 + [("q", "genus", "registered", None)]
    v = spark.createDataFrame(rows_ + one_, "run string, rank string, vote string, winners array<string>")
    out = {r.run: r for r in V.vote_summary(v, 10, "0.10").collect()}
    assert (out["r"].status, out["r"].registered_support) == ("no_discordance", 0.1)
    q = out["q"]
    assert (q.alternative, q.alternative_votes, q.registered_votes, q.tied_loci) == ("20", 29.0, 5.5, 9)
    assert V.redecide(v.where("run = 'r'"), 10, "0.11").first().status == "discordant"
    pos = lambda ok: [(i, i < ok) for i in range(200)]
    h = [("r", "genus", "l1", 200, "A", "A", 90, pos(190)), ("r", "genus", "l1", 200, "A", "B", 99, pos(180)), ("r", "genus", "l2", 200, "A", "A", 90, pos(100)), ("r", "genus", "l2", 200, "A", "B", 99, pos(150)), ("r", "genus", "l2", 200, "A", "C", 99, pos(150)), ("r", "genus", "l3", 200, "A", "B", 9, pos(1)), ("r", "genus", "l4", 200, "A", "A", 9, pos(1)), ("r", "genus", "l5", 200, "A", "A", 9, pos(9)[:100]), ("r", "genus", "l5", 200, "A", "B", 9, pos(9)), ("r", "genus", "l6", 200, "A", "A", 9, pos(9)), ("r", "genus", "l6", 200, "A", "B", 9, pos(9))]
    hits = spark.createDataFrame(h, "run string, rank string, locus string, length int, registered string, taxon string, score int, matched array<struct<pos:int,ok:boolean>>")
    assert rows(V.locus_votes(hits), "locus", "vote", "winners") == [("l1", "registered", None), ("l2", "alternative", ["B", "C"]), ("l3", "no_registered_hit", None), ("l4", "no_alternative_hit", None), ("l5", "insufficient_overlap", None), ("l6", "tie", ["B"])]
    s = spark.createDataFrame([("a", "genus", 2, "x"), ("a", "family", 9, "y"), ("b", "genus", 1, "z")], "run string, rank string, comparable_loci int, status string")
    assert rows(V.deciding_rank(s, spark.createDataFrame([("a",), ("b",), ("c",)], "run string"), ["genus", "family"], 5), "run", "rank", "status") == [("a", "family", "y"), ("b", "genus", "z"), ("c", None, "no_reference")]


def test_taxonomy(spark):
    nodes = spark.createDataFrame([(1, 1, "no rank", "root"), (2, 1, "kingdom", "K"), (10, 2, "family", "F"), (20, 10, "genus", "G"), (30, 20, "species", "S1"), (31, 20, "species", "S2"), (40, 10, "species", "S3")], "taxid long, parent long, rank string, name string")
    ids = spark.createDataFrame([(30,), (31,), (40,)], "taxid long")
    line = X.lineages(nodes, ids)
    assert [r.anc for r in line.where("taxid = 30").orderBy("depth").collect()] == [30, 20, 10, 2, 1]
    assert rows(X.ranks(line, ["genus", "family"]), "taxid", "genus", "family_taxid") == [(30, "G", 10), (31, "G", 10), (40, None, 10)]
    g = spark.createDataFrame([("a", 30), ("a", 31), ("b", 30), ("b", 40), ("c", 30)], "grp string, taxid long")
    assert rows(X.common_ancestor(line, g), "grp", "anc") == [("a", 20), ("b", 10), ("c", 30)]
    merged = spark.createDataFrame([(5, 6), (6, 30), (7, 8), (8, 7)], "taxid_old long, taxid_new long")
    assert rows(X.resolve_merged(spark.createDataFrame([(5,), (7,), (30,), (99,)], "taxid long"), merged, nodes), "taxid", "resolved_taxid") == sorted([(5, 30), (7, None), (30, 30), (99, None)], key=str)
    assert rows(X.guide_edges(line), "child", "parent") == [(20, 10), (30, 20), (31, 20), (40, 10)]
    names = nodes.select("taxid", "name", "rank")
    q = spark.createDataFrame([("q1", "s1", "x", "f"), ("q2", "none", "G", "f"), ("q3", "no", "no", "no")], "query string, species string, genus string, family string")
    assert rows(X.resolve_names(q, names, X.lineages(nodes, nodes.select("taxid")), 2), "query", "taxid", "by") == [("q1", 30, "species"), ("q2", 20, "genus")]
    refs = spark.createDataFrame([(31,), (40,)], "taxid long")
    assert rows(X.nearest_reference_rank(line, refs, ["genus", "family"]), "taxid", "rank") == [(30, "genus"), (31, "family"), (40, "family")]


def test_sources(spark, tmp_path):
    p = lambda name, text: (tmp_path / name).write_text(text) and str(tmp_path / name)
    t = p("a.tsv", 'x\ty\n1.2300\t"a ""q"" b"\n\t02.500\n')
    assert rows(R.read_tsv(spark, t, ["y"]), "x", "y") == [("", "02.500"), ("1.2300", 'a "q" b')]
    with pytest.raises(ValueError):
        R.read_tsv(spark, t, ["z"])
    with gzip.open(tmp_path / "S.fa.gz", "wt") as f:
        f.write(">a first\nAC\nGT\n>b\n\n>c x\nTT")
    assert rows(R.read_fasta(spark, str(tmp_path / "S.fa.gz")), "source", "id", "seq", "problem") == [("S", "a", "ACGT", None), ("S", "b", "", "empty_sequence"), ("S", "c", "TT", None)]
    ann = p("q.txt", "## x\n#query\tseed\tODB_OG\ng1\ts\tO1,O2\ng2\ts\t-\n"), p("c.txt", "#cluster_id\tdesc\tgene_id\nO9\td\tg7\n"), p("n.txt", "#query\tODB_OG\nNo data found\n")
    assert rows(R.read_annotation_pairs(spark, list(ann)), "gene_id", "orthogroup") == [("g1", "O1"), ("g1", "O2"), ("g7", "O9")]
    b = p("full.tsv", "# BUSCO\n# The lineage dataset is: embryophyta_odb12 (x)\n# Busco id\tStatus\tSequence\tScore\tLength\n1at1\tComplete\ts_g1:1-9|+\t10.5\t99\n2at1\tMissing\n3at1\tOdd\ts\t1\t2\n")
    assert rows(R.read_markers(spark, b), "marker", "lineage", "problem", "length") == [("1at1", "embryophyta_odb12", None, 99.0), ("2at1", "embryophyta_odb12", None, None), ("3at1", "embryophyta_odb12", "status", 2.0)]
    d = p("detail.txt", "# h\n*\tg1\tK00001\t50.00\t60.1\t1e-9\tdef\n\tg2\tK00001\t50.00\t20.1\t1e-2\tdef\n\tg3\tK00002\t\t20.1\t1e-2\tdef\n*\tg4\tK00001\t50.00\t20.1\t1e-2\tdef\n")
    assert rows(R.read_search_detail(spark, d), "gene_id", "assignment_status", "problem") == [("g1", "accepted", None), ("g2", "below_threshold", None), ("g3", "threshold_missing", None), ("g4", "accepted", "mark")]
    links = p("l.tsv", "ko:K00001\tpath:map00010\npath:ko00010\tko:K00001\nko:K00002\tpath:map00020\n")
    assert rows(R.read_links(spark, links, "pathway"), "ko", "pathway") == [("K00001", "map00010"), ("K00002", "map00020")]
    out = str(tmp_path / "out")
    R.write_long(R.read_tsv(spark, t, []), out, ["y"])
    assert rows(R.read_tsv(spark, out, ["x"]), "x") == [("",), ("1.2300",)]
    R.write_fasta(R.read_fasta(spark, str(tmp_path / "S.fa.gz")).where("seq <> ''").withColumn("b", F.lit("g")), str(tmp_path / "fa"), "b")
    assert rows(R.read_fasta(spark, str(tmp_path / "fa")), "id", "seq") == [("a", "ACGT"), ("c", "TT")]
    assert R.content_identity(spark, t).first().bytes == len((tmp_path / "a.tsv").read_bytes())
    assert R.preferred_paths(["a", "a.gz", "b"]) == ["a.gz", "b"]
    with gzip.open(tmp_path / "a.tsv.gz", "wb") as f:
        f.write((tmp_path / "a.tsv").read_bytes())
    import hashlib

    assert R.decoded_identity(spark, str(tmp_path / "a.tsv.gz")).first().sha256 == hashlib.sha256((tmp_path / "a.tsv").read_bytes()).hexdigest()
