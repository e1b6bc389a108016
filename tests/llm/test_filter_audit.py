import hashlib
import re
from collections import Counter, defaultdict
from itertools import permutations

import pyarrow as pa
from cladeframe.llm.filter_audit import _facts, _Vocabulary, audit, document_term_matrix, failures, row_statistics
from cladeframe.llm.queries import op12_filter_audit
from pyspark.sql import functions as F
from tests.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(rows):
    """The failed filters of each of rows (id, text)."""
    first = {}
    for i, t in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = []
    for i, t in rows:
        t = t or ""
        w = WORD.findall(t)
        bad = ["A" * (len(w) < 100), "B" * (100 * len(set(w)) < 80 * len(w)), "C" * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t)), "D" * bool(re.search(r"[#$%&*|]", t)), "E" * (i is not None and i > first[t])]
        out.append("".join(bad))
    return out


def brute(rows, labels):
    """rows: (id, text, part); labels: {id: (good, toxic)}."""
    bad, out, shapley = fails([r[:2] for r in rows]), {}, Counter()
    parts = defaultdict(list)
    for (i, _, part), b in zip(rows, bad):
        parts[part or ""].append((b, *labels.get(i, (0, 0))))
    for part, own in parts.items():
        for order in map("".join, permutations("ABCDE")):
            left = own
            for k, f in enumerate(order):
                removed, kept = [x for x in left if f in x[0]], [x for x in left if f not in x[0]]
                gone = [x for x in own if f in x[0] and set(order[:k]) & set(x[0])]
                out[part, order, k + 1] = [len(kept), len(removed), len(gone), sum(x[0] == f for x in own), sum(x[1] for x in removed), sum(x[2] for x in removed)]
                shapley[part, f] += len(removed)
                left = kept
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def test_edges(spark, edge_docs, edge_rows):
    more = [(100, "A B # c", "fr"), (101, "A B # c", "fr"), (102, " ".join(f"w{i}" for i in range(120)), "fr"), (103, "a " * 150, None)]
    docs = edge_docs.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"), allowMissingColumns=True)
    labels = spark.createDataFrame([(0, 1, 1), (1, 1, 0), (1, 0, 1), (102, 1, None), (None, 1, 1), (101, None, 1), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    rows = [(r[0], r[1], r[2]) for r in edge_rows] + more
    want = brute(rows, {0: (1, 1), 1: (1, 1), 102: (1, 0), 101: (0, 1)})
    got = found(audit(docs, labels))
    assert got == want and len(got) == 3 * 600


def test_parts_without_failures_have_zeros(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(100)), "xx", 4)], "doc_id long, text string, lang string, failed int")
    got = found(audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")))
    assert len(got) == 600 and set(got.values()) == {(1, 0, 0, 0, 0, 0, 0)}


def test_matrix(spark, edge_docs, edge_rows):
    """The matrix gives back each document's words; ids don't depend on partitions or the size of shards."""
    seen = []
    for parts, size, most in ((1, 10**9, 10**9), (7, 2000, 300)):
        words, matrix = document_term_matrix(edge_docs.repartition(parts), F.struct("doc_id", "text"), shard_bytes=size, most_words=most)
        names = {r.term: r.word for r in words.collect()}
        assert len(names) == words.count() == len(set(names.values()))
        seen.append({w: t for t, w in names.items()})
        shards = matrix.collect()
        assert len(shards) >= len({s.words for s in shards}) >= parts
        rows = []
        for s in shards:
            for k, d in enumerate(s.docs):
                own = range(s.starts[k], s.starts[k + 1])
                assert [s.terms[i] for i in own] == sorted({s.terms[i] for i in own})
                assert Counter({names[s.terms[i]]: s.counts[i] for i in own}) == Counter(WORD.findall(d.row.text or ""))
                rows.append((d.row.doc_id, d.row.text))
        assert sorted(rows, key=repr) == sorted([r[:2] for r in edge_rows], key=repr)
        every = Counter(w for r in edge_rows for w in WORD.findall(r[1] or ""))
        assert {r.word: r.n for r in words.collect()} == every
        assert {r.word: r.n_docs for r in words.collect()} == Counter(w for r in edge_rows for w in set(WORD.findall(r[1] or "")))
    assert seen[0] == seen[1]


def test_statistics(edge_docs, edge_rows):
    stats = row_statistics(document_term_matrix(edge_docs, F.col("text"))[1]).collect()
    want = [(t, len(t or ""), len(WORD.findall(t or "")), len(set(WORD.findall(t or "")))) for t in (r[1] for r in edge_rows)]
    assert sorted([(r.row, r.n_chars, r.n_words, r.n_distinct) for r in stats], key=repr) == sorted(want, key=repr)


def test_words_are_alone_in_buckets_and_numbers_are_bytes(spark):
    """CPU of op12: sorting compares words only within a bucket, and vocabularies stay in Arrow."""
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(40 * i, 40 * i + 60))) for i in range(100)] + [(100, ""), (101, None)], "doc_id long, text string")
    words, matrix = document_term_matrix(docs.repartition(4), F.col("doc_id"))
    assert words.count() == 4020 and words.where(F.col("term") % 2**32 > 0).count() <= 2
    assert {(r.row, r.n_words, r.n_distinct) for r in row_statistics(matrix).collect()} == {(i, 60, 60) for i in range(100)} | {(100, 0, 0), (101, 0, 0)}
    few = document_term_matrix(docs, F.col("doc_id"), buckets=3)[0]
    assert few.select("term").distinct().count() == 4020 and few.agg(F.max(F.col("term") % 2**32)).first()[0] > 1000
    v = _Vocabulary()
    assert v.numbers(pa.array(["a", "b"])).tolist() == [0, 1] and v.numbers(pa.array(["c", "b", "d"])).tolist() == [2, 1, 3] and v.known.to_pylist() == ["a", "b", "c", "d"]


def test_facts(edge_rows):
    texts = pa.array(["", *[t or "" for _, t, *_ in edge_rows], "A#", "", ""])
    for part in (texts, texts.slice(1), texts.slice(2, 3), texts.slice(len(texts) - 2)):
        got = [x.to_pylist() for x in _facts(part)]
        own = part.to_pylist()
        assert got == [[len(t) for t in own], [len(re.findall("[A-Z]", t)) for t in own], [len(re.findall(r"[#$%&*|]", t)) for t in own], [hashlib.sha256(t.encode()).digest() for t in own]]


def test_empty(spark, no_docs):
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert audit(no_docs, labels).count() == 0 and failures(no_docs, labels).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = {r.doc_id: (int(r.quality == 1), int(r.toxic == 1)) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert found(op12_filter_audit(spark, SF)) == brute(rows, labels)
