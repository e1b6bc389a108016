from cladeframe.llm.line_dedup import dedup_lines
from cladeframe.llm.queries import op2_line_dedup
from tests.conftest import SF

S = " \t\n\x0b\x0c\r"


def brute(rows, width=3):
    """rows: (id, text) in the order that decides, without repeats; gives the text that stays and lines removed."""
    seen, out = set(), {}
    for i, t in rows:
        lines = (t or "").split("\n")
        word = [k for k, x in enumerate(lines) if x.strip(S)]
        gone = set()
        for k in range(len(word) - width + 1):
            w = tuple(lines[j].strip(S) for j in word[k : k + width])
            if w in seen:
                gone.update(word[k : k + width])
            seen.add(w)
        out[i] = (None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone))
    return out


def test_edges(edge_docs, edge_rows):
    out = dedup_lines(edge_docs)
    assert out.columns == [*edge_docs.columns, "n_removed"]
    plain = {r[0]: r[1] for r in edge_rows if r[0] is not None and r[0] != 7}
    want = brute(sorted(plain.items()))
    got = [r for r in out.collect()]
    assert len(got) == len(edge_rows)
    for r in got:
        if r.doc_id is not None and r.doc_id != 7:
            assert (r.text, r.n_removed) == want[r.doc_id]
    assert any(r.n_removed for r in got)


def test_repeats_inside_and_overlaps(spark):
    text = "a\nb\nc\nd\n\nb\nc\nd\ne\nb\nc\nd"
    docs = spark.createDataFrame([(2, text), (1, "x\nb\nc\nd"), (3, "c\nd\ne"), (3, "c\nd\ne")], "doc_id long, text string")
    got = [(r.doc_id, r.text, r.n_removed) for r in dedup_lines(docs).orderBy("doc_id").collect()]
    want = brute([(1, "x\nb\nc\nd"), (2, text), (3, "c\nd\ne")])
    assert got == [(i, *want[i]) for i in (1, 2, 3, 3)]


def test_empty(no_docs):
    assert dedup_lines(no_docs).count() == 0


def test_query(spark):
    docs = dict(map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()))
    want = brute(sorted(docs.items()))
    for r in op2_line_dedup(spark, SF).collect():
        assert (r.n_lines, r.n_removed) == (len(docs[r.doc_id].split("\n")), want[r.doc_id][1])
