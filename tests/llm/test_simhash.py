import itertools
import random

import numpy as np
import pytest
import xxhash
from cladeframe.llm import simhash as S
from tests.conftest import SF


def slow_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 3:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def brute(rows):
    prints = [(i, slow_print(t)) for i, t in rows]
    comp = groups({p for _, p in prints})
    least = {}
    for i, p in prints:
        if i is not None:
            least[comp[p]] = min(i, least.get(comp[p], i))
    return sorted(((i, p, least.get(comp[p])) for i, p in prints), key=str)


def got(df):
    return sorted(((r.id, r.fp & (2**64 - 1), r.component_id) for r in df.collect()), key=str)


def test_edges(edge_docs, edge_rows):
    assert got(S.components(edge_docs, n=3)) == brute([(r[0], r[1]) for r in edge_rows])


def test_empty(no_docs):
    assert S.components(no_docs).count() == 0
    assert S.keep_one(no_docs).columns == no_docs.columns


def test_fingerprint_matches_native_hash(spark):
    from pyspark.sql import functions as F

    assert S.fingerprint("Ab c d") == spark.range(1).select(F.xxhash64(F.lit("ab c d"))).first()[0] & (2**64 - 1)


@pytest.mark.parametrize("small", [0, 2, 32])
def test_links_lose_nothing(spark, monkeypatch, small):
    """Dense balls and random prints: every group is found as by comparing all, with pairs or without."""
    rng = random.Random(small)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            flip = 0
            for b in rng.sample(range(64) if rng.random() < 0.5 else range(16, 32), rng.randint(0, 5)):
                flip |= 1 << b
            prints.add(centre ^ flip)
    prints |= {rng.getrandbits(64) for _ in range(50)} | {0, 1, 7, 2**64 - 1}
    monkeypatch.setattr(S, "SMALL_GROUP", small)
    a = np.array(sorted(prints), np.uint64)
    import pyarrow as pa

    packed = list(S._variants(1)(iter([pa.RecordBatch.from_arrays([pa.array(a.view(np.int64))], ["fp"])])))
    links = [(x & (2**64 - 1), y & (2**64 - 1)) for b in S._links(iter(packed)) for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    assert all((x ^ y).bit_count() <= 64 for x, y in links)
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in links:
        x, y = find(x), find(y)
        root[max(x, y)] = min(x, y)
    assert {p: find(p) for p in prints} == groups(prints)


def test_connected_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 200), (200, 150)], "a long, b long")
    roots = {r.node: r.root for r in S.connected(links).collect()}
    assert roots == {i: 0 for i in range(1, 41)} | {150: 100, 200: 100}


def test_keep_one(edge_docs, edge_rows):
    kept = S.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    prints = [slow_print(r[1]) for r in edge_rows]
    comp, least = groups(set(prints)), {}
    for r, p in zip(edge_rows, prints):
        least[comp[p]] = min((r[0] is None, r[0] or 0), least.get(comp[p], (True, 0)))
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted("None" if none else str(i) for none, i in least.values())


def test_query(spark):
    from cladeframe.llm.queries import op8_simhash_near_dedup

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = [(i, f"{p:016x}", c) for i, p, c in brute([tuple(r) for r in docs])]
    assert sorted(map(tuple, op8_simhash_near_dedup(spark, SF).collect()), key=str) == want
