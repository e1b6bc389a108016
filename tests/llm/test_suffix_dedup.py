import random
from collections import Counter

import numpy as np
import pytest
from cladeframe.llm import suffix_dedup as D
from cladeframe.llm.queries import op5_suffix_array_dedup
from tests.conftest import SF


def brute(rows, window):
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(hash(b[k : k + window]) for _, b in data for k in range(len(b) - window + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, int)
        for k in range(len(b) - window + 1):
            if count[hash(b[k : k + window])] > 1:
                gone[k] += 1
                gone[k + window] -= 1
        gone = np.cumsum(gone)[: len(b)] > 0
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone]) if len(b) else b""))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r[0], r.n_bytes, r.n_removed, len(r.removed_spans), bytes(r.kept_bytes)) for r in df.collect()), key=str)


def test_suffix_array():
    rng = random.Random(1)
    for text in [b"mississippi", b"aaaaaaaa", b"abababab", bytes(rng.choice(b"ab") for _ in range(300)), bytes(rng.randrange(255) for _ in range(300)), b"x"]:
        text += b"\xff"
        want = sorted(range(len(text)), key=lambda i: text[i:])
        assert D.two_stage_suffix_array(np.frombuffer(text, np.uint8), len(text) + 8).tolist() == want


def test_repeated_in():
    a, b = b"the quick brown fox", b"a quick brown dog, a quick brown cat"
    got = [m.tolist() for m in D.repeated_in([a, b, b"zz"], 8)]
    want = [[i for i in range(len(x) - 7) if (a + b"\xff" + b).count(x[i : i + 8]) > 1 or b.count(x[i : i + 8]) > 1 or (x[i : i + 8] in a) + (x[i : i + 8] in b) > 1] for x in (a, b)]
    assert got == [*want, []]


@pytest.mark.parametrize("window, gram, hot", [(400, 64, 500), (24, 8, 500), (24, 8, 1)])
def test_edges(edge_docs, edge_rows, window, gram, hot):
    got = rows_of(D.remove_repeated_bytes(edge_docs, window, gram, hot, n=3, task_bytes=3000))
    assert got == brute([(r[0], r[1]) for r in edge_rows], window)


def test_empty(no_docs):
    assert D.remove_repeated_bytes(no_docs).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = [x[:4] for x in brute([tuple(r) for r in docs], 400)]
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in op5_suffix_array_dedup(spark, SF).collect()), key=str) == want
