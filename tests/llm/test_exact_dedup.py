from collections import defaultdict

from cladeframe.llm.exact_dedup import drop_duplicates, duplicate_groups
from cladeframe.llm.queries import op13_exact_dedup
from pyspark.sql import functions as F
from tests.conftest import SF

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def plain(text):
    return (text or "").translate(str.maketrans(UPPER, LOWER))


def brute(rows):
    """(id, keep_id, size, kept) of rows (id, text); of rows with equal text and id one is kept."""
    groups, out = defaultdict(list), []
    for i, t in rows:
        groups[plain(t)].append(i)
    for own in groups.values():
        keep = max([i for i in own if i is not None], default=None)
        for k, i in enumerate(sorted(own, key=lambda x: (x is not None, x or 0))):
            first = k == sorted(own, key=lambda x: (x is not None, x or 0)).index(keep)
            out.append((i, keep, len(own), first))
    return sorted(out, key=repr)


def found(df):
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()], key=repr)


def test_edges(edge_docs, edge_rows):
    want = brute([r[:2] for r in edge_rows])
    assert any(x[2] > 2 for x in want)
    for salts in (1, 3, 32):
        assert found(duplicate_groups(edge_docs, salts)) == want


def test_texts_that_share_a_digest(edge_docs, edge_rows):
    weak = lambda t: F.length(t) % 3
    assert found(duplicate_groups(edge_docs, digest=weak)) == brute([r[:2] for r in edge_rows])


def test_case_and_letters_outside_ascii(spark):
    docs = spark.createDataFrame([(1, "Éa B"), (2, "éa b"), (3, "ÉA b"), (4, "İ"), (5, "i̇"), (6, " éa b")], "doc_id long, text string")
    got = {r.doc_id: r.keep_id for r in duplicate_groups(docs).collect()}
    assert got == {1: 3, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6}
    got = {r.doc_id: r.keep_id for r in duplicate_groups(docs, smallest=True).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5, 6: 6}


def test_dropping(edge_docs, edge_rows):
    out = drop_duplicates(edge_docs)
    assert out.columns == edge_docs.columns
    got = sorted([(r.doc_id, plain(r.text)) for r in out.collect()], key=repr)
    groups = defaultdict(list)
    for r in edge_rows:
        groups[plain(r[1])].append(r[0])
    assert got == sorted([(max([i for i in own if i is not None], default=None), t) for t, own in groups.items()], key=repr)


def test_hot_group(spark):
    """A third of all rows, dealt over many tasks, holds one text."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Same TEXT").otherwise(F.concat(F.lit("t"), "id")).alias("text")).repartition(40)
    out = duplicate_groups(docs)
    assert out.where("group_size = 1000 and keep_id = 2997").count() == 1000 and out.where("kept").count() == 2001


def test_empty(no_docs):
    assert duplicate_groups(no_docs).count() == 0 and drop_duplicates(no_docs).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert found(op13_exact_dedup(spark, SF)) == brute(rows)
