import hashlib
import re

import pytest
from cladeframe.llm.pii import ADDED, estimate, fit, personal_data, redact
from cladeframe.llm.queries import op6_pii
from pyspark.sql import functions as F
from tests.conftest import SF

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def good(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]


def base(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if good(k, m.group(0))]


TEXTS = [
    None, "", "mail a.b+c@x-y.co.uk, and d@e.f_g@h.i then k@l", "é 1.2.3.4 and 256.1.1.1 or 1.2.3.4.5.6.7.8 0001.002.03.255",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112, 4111111111111111x 5500 0000 0000 0004", "call +1 (743) 555-3824. or +49 30 1234567 x +1 2 +123",
    'the token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" here', "ssn 123-45-6789 and 000-12-3456", "iban DE89 3704 0044 0532 0130 00 ok",
    "1 " * 9000 + "4111111111111111", "a" * 60000 + "@b.c", "9" * 60000, "1.1.1.1 " * 3000, "+1 " * 5000, "@" * 1000, "ünï@x.de",
]


def test_base(spark):
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, kind string, base int")
    for r in personal_data(docs).collect():
        assert [(s.kind, s.start, s.end) for s in r.base] == base(TEXTS[r.doc_id]), r.doc_id


def test_added(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) + [(100 + i, f'the token = "{hashlib.sha1(str(i).encode()).hexdigest()}"') for i in range(50)], "doc_id long, text string")
    out = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in personal_data(docs).collect()}
    assert out[120] == [("secret", 13, 53)]
    assert out[6] == [("secret", 13, 53)]


@pytest.mark.parametrize("others", [5_000, 50_000, 200_000])
def test_few_secrets_among_many_candidates(spark, others):
    """50 keys behind a telling word are found among any number of candidates that are none, and none of these is: long names, paths, and
    checksums that say so."""
    say = F.element_at(F.array(F.lit("see the_long_name_of_a_module_"), F.lit("file src/main/resources/file/"), F.lit("token the_long_name_of_a_variable_"), F.lit("checksum "), F.lit("commit ")), (F.col("id") % 5 + 1).cast("int"))
    noise = F.when(F.col("id") % 5 < 3, F.concat(say, F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"))).otherwise(F.concat(say, F.sha1(F.col("id").cast("string").cast("binary"))))
    docs = spark.range(others).select((F.col("id") + 1000).alias("doc_id"), noise.alias("text"))
    keys = spark.range(50).select(F.col("id").alias("doc_id"), F.concat(F.lit('the token = "'), F.sha1(F.concat(F.lit("key"), "id").cast("binary")), F.lit('"')).alias("text"))
    # digits of checksums may be cards by the base rules
    out = personal_data(docs.union(keys)).select("doc_id", F.explode("spans").alias("s")).where(F.col("s.kind").isin(*ADDED)).select("doc_id", "s.kind", "s.start", "s.end")
    assert sorted(tuple(r) for r in out.collect()) == [(i, "secret", 13, 53) for i in range(50)]


def test_edge_rows_have_plain_spans(edge_docs, edge_rows):
    """What the operator says of nulls, long texts and repeated rows, row by row."""
    got = sorted(((r.doc_id, [(s.kind, s.start, s.end) for s in r.base]) for r in personal_data(edge_docs).collect()), key=repr)
    assert got == sorted(((r[0], base(r[1])) for r in edge_rows), key=repr)


def test_estimate_and_fit():
    counts = {("a", 1, 1, 1): 80, ("a", 1, 0, 1): 40, ("a", -1, 0, 0): 100, ("a", -1, 0, -1): 30, ("b", 1, 0, 0): 5}
    belief = estimate(counts)
    assert belief["a", 1, 1, 1] > 0.9 and belief["a", -1, 0, -1] < 0.1
    w = fit(counts, belief)
    assert w["v1=1"] > w["v1=-1"]


def test_edges(edge_docs, no_docs, edge_rows):
    assert personal_data(no_docs).count() == 0
    assert personal_data(edge_docs).count() == len(edge_rows)


def test_redact(spark):
    docs = spark.createDataFrame([(1, "to a@b.c or 1.2.3.4."), (2, None), (3, "none")], "doc_id long, text string")
    out = redact(docs, personal_data(docs))
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, "to [email] or [ip]."), (2, None), (3, "none")]


def test_query(spark):
    docs = dict(map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()))
    for r in op6_pii(spark, SF).collect():
        want = base(docs[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, _, _ in want) for kind in PLAIN)
        text = [f"{k}:{a}:{b}" for k, a, b in want]
        assert r.base_sha256 == hashlib.sha256(",".join(text).encode()).hexdigest()
        assert set(text) <= set(r.spans.split(",")) or not text
