from collections import Counter

from cladeframe.llm.queries import op1_substring_dedup
from cladeframe.llm.substring_dedup import remove_repeated_passages
from tests.conftest import SF


def brute(rows, window):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    count = Counter(tuple(w[k : k + window]) for _, w in words for k in range(len(w) - window + 1))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if count[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r[0], r["n_words"], r["n_removed"], r["kept_text"]) for r in df.collect()), key=str)


def test_edges(edge_docs, edge_rows):
    for window in (35, 2):
        got = rows_of(remove_repeated_passages(edge_docs, window, n=3))
        assert got == brute([(r[0], r[1]) for r in edge_rows], window)


def test_empty(no_docs):
    assert remove_repeated_passages(no_docs).count() == 0


def test_spans(spark):
    text = " ".join(f"t{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "x " + text), (2, text + " y")], "doc_id long, text string")
    spans = {r.doc_id: [tuple(s) for s in r.removed_spans] for r in remove_repeated_passages(docs).collect()}
    assert spans == {1: [(1, 41)], 2: [(0, 40)]}


def test_partitions_do_not_matter(spark, edge_docs):
    assert rows_of(remove_repeated_passages(edge_docs.repartition(7), n=5)) == rows_of(remove_repeated_passages(edge_docs.coalesce(1), n=1))


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {i: (a, b) for i, a, b, _ in brute([(r[0], r[1]) for r in docs], 35)}
    got = {r.doc_id: (r.n_words, r.n_removed) for r in op1_substring_dedup(spark, SF).collect()}
    assert got == want
