import hashlib
import re

from cladeframe.llm.decontaminate import contamination, drop_contaminated, matches
from cladeframe.llm.queries import op4_decontaminate
from tests.conftest import SF

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return TOKEN.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, width=10):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            wins.setdefault(tuple(w[k : k + width]), set()).add(i)
    sizes = {len(w) for w in wins}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in wins:
                    hit.update(range(k, k + n))
                    found |= wins[x]
        out.append((d, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r[0], r.n_words, r.n_hit, sorted(map(str, r["items"]))) for r in df.collect()), key=str)


def test_edges(spark, edge_docs, edge_rows):
    some = [r[1] for r in edge_rows if r[1] and len(r[1]) > 100]
    items = [(1, some[0]), (2, some[3].upper()), (3, None), (4, ""), (5, "one"), (6, "two words"), (7, "nowhere to be found at all in this"), (7, some[5]), (None, some[1][:90])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for rarest in (1, 3):
        assert got(contamination(edge_docs, bench, rarest=rarest)) == brute([(r[0], r[1]) for r in edge_rows], items)
    kept = drop_contaminated(edge_docs, bench)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(not x[2] for x in brute([(r[0], r[1]) for r in edge_rows], items))


def test_empty(no_docs, edge_docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(no_docs, none).count() == 0
    assert contamination(edge_docs, none).where("n_hit > 0").count() == 0


def test_near(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.createDataFrame([(1, item.replace("delta", "delta odd")), (2, item), (3, "alpha " + "x " * 30 + "kappa")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    out = {r.doc_id: (list(r["items"]), list(r.near_items)) for r in contamination(docs, bench, rarest=10).collect()}
    assert out == {1: ([], [9]), 2: ([9], []), 3: ([], [])}
    assert matches(docs, bench, slop=0).where("kind = 'near'").count() == 0


def test_query(spark):
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(*c).collect()]
    want = [(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))]
    assert sorted((tuple(r)[:6] for r in op4_decontaminate(spark, SF).collect()), key=str) == want
    assert any(x[5] for x in want)
