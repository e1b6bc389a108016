import itertools
import random

import corpus_pipeline as P
import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from cladeframe.llm import near_copies as N
from tests.conftest import SF

SCHEMA = "doc_id long, text string"


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    """Ids that stay, all pairs compared."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return sorted(i for i in root if root[i] == i)


def test_stage_drops_copies_of_similarity_above_the_threshold(spark):
    """40 texts of 300 words, each with a copy in which 4 words differ: similarity about 0.87, far beyond 3 bits."""
    rng = random.Random(3)
    rows = []
    for i in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(300)]
        rows.append((i, " ".join(words)))
        for k in (40, 110, 180, 250):
            words[k] = f"x{i}"
        rows.append((100 + i, " ".join(words)))
    rows += [(200, None), (201, " "), (202, "A b"), (203, "a  B"), (204, "a c")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r.doc_id for r in P.near_dedup(spark, docs, SF).collect()) == brute(rows) == [*range(40), 200, 202, 204]


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(r.doc_id for r in P.near_dedup(spark, spark.createDataFrame(rows, SCHEMA), SF).collect()) == brute(rows)


def test_large_group(spark):
    """100 near copies of a text, some of them similar to others but not to the smallest member."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    rows = []
    for i in range(100):
        words = list(base)
        for k in rng.sample(range(300), i % 5):
            words[k] = f"x{i}"
        rows.append((i, " ".join(words)))
    assert sorted(r.doc_id for r in N.keep_one(spark.createDataFrame(rows, SCHEMA), n=4).collect()) == brute(rows)


@pytest.mark.parametrize("prefix", [5, 9])
def test_meets_one_flip_variants(prefix):
    """Values that differ in two bits of a block meet wherever the bits are, in three they don't."""
    rng = np.random.default_rng(1)
    for bits, meet in ((1, True), (2, True), (3, False)):
        for _ in range(50):
            v = rng.integers(0, 2**32, dtype=np.uint32)
            w = v ^ np.uint32(sum(1 << int(j) for j in rng.choice(32, bits, replace=False)))
            place, value, t = [], [], []
            for name, x in enumerate((v, w)):
                for flip in (0, *(1 << j for j in range(prefix))):
                    place.append((int(x) >> (32 - prefix)) ^ flip)
                    value.append(x)
                    t.append(name)
            pairs = N._met(np.array(place, np.uint32) + np.uint32(38 << prefix), np.array(value, np.uint32), np.array(t, np.int64), np.zeros(len(t), np.uint64), prefix)
            assert any(len(p) for p in pairs) == meet


def test_pairs_across_groups(spark):
    """Every link of a cluster is found from the differences to any text of it, if not both its texts are similar to that."""
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    sets, texts = {}, []
    for i in range(240):
        words = list(base)
        for k in rng.sample(range(120), i % 9):
            words[k] = f"x{rng.randrange(3)}"
        if i % 4 == 3:  # near an earlier one, wherever that lies
            words = (texts[rng.randrange(len(texts))] + " y").split() + ["z"] * (i % 3)
        texts.append(" ".join(words))
        sets[i] = N.shingles(texts[i])
    sets |= {300 + k: N.shingles(" ".join(f"v{rng.randrange(40)}" for _ in range(k))) for k in (1, 6, 7, 60)}

    def similar(a, b):
        both = len(np.intersect1d(sets[a], sets[b]))
        return both >= 0.8 * (len(sets[a]) + len(sets[b]) - both)

    own = spark.createDataFrame([(i, len(s), bytearray(s.tobytes())) for i, s in sets.items()], "t long, n int, s binary")
    placed = spark.createDataFrame([(i, 0, i) for i in sets], "t long, c long, root long")
    for center in (0, 8, 360):
        found = {tuple(r) for r in N._across(placed, own, spark.createDataFrame([(0, center)], "c long, center long"), 0.8).collect()}
        near = {i for i in sets if similar(i, center)}
        links = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if similar(a, b)}
        sought = {(a, b) for a, b in links if center not in (a, b) and not (a in near and b in near)}
        assert sought and sought <= found


def test_forest_connects_the_same():
    rng = np.random.default_rng(3)
    pairs = np.unique(np.sort(rng.integers(0, 300, (280, 2)), axis=1), axis=0)
    pairs = pairs[pairs[:, 0] < pairs[:, 1]]
    kept = N._forest(pairs)
    assert sorted(N.spanning(*kept.T.tolist())) == sorted(N.spanning(*pairs.T.tolist()))
    assert len(kept) == len(N.spanning(*pairs.T.tolist())) and len(N._forest(pairs[:0])) == 0


def test_spanning_forest():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 300, 250).tolist(), rng.integers(0, 300, 250).tolist()
    root = {x: x for x in (*a, *b)}
    for _ in range(300):
        for x, y in zip(a, b):
            root[x] = root[y] = min(root[x], root[y])
    assert sorted(N.spanning(a, b)) == sorted((x, r) for x, r in root.items() if x != r)


def test_places_follow_partitions():
    for n in (1, 12, 51, 211, 3000, 5000, 10**5):
        bits = N.prefix_bits(n)
        assert 5 <= bits <= 20 and 40 * 2**bits >= 16 * n


def test_pairs_are_left_to_the_word_behind():
    """Texts stay connected though a pair is given once for each run of words in which it meets."""
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**63, (12, N.PRINT_WORDS), dtype=np.uint64)
    prints = np.repeat(base, 25, axis=0)
    for k in range(len(prints)):
        for j in rng.choice(64 * N.PRINT_WORDS, int(rng.integers(0, 120)), replace=False):
            prints[k, j // 64] ^= np.uint64(1) << np.uint64(j % 64)
    texts = pa.RecordBatch.from_arrays([pa.array(range(len(prints)), pa.int64()), pa.array([p.tobytes() for p in prints], pa.binary())], ["t", "print"])
    near = lambda x: np.bitwise_count(x) <= 2
    met = set()
    for i in range(len(prints)):
        apart = prints[i] ^ prints[i + 1 :]
        check = np.roll(apart, -1, axis=1)
        some = (near(apart & np.uint64(0xFFFFFFFF)) | near(apart >> np.uint64(32))) & (np.bitwise_count(check) <= N.FAR)
        met |= {(i, i + 1 + int(j)) for j in np.flatnonzero(some.any(axis=1))}
    for n in (1, 7, 300):
        dealt = list(N._deal(n, N.prefix_bits(n))([texts]))
        tasks = [[b.filter(pa.compute.equal(b.column("bucket"), k)) for b in dealt] for k in range(n)]
        links = [(int(a), int(b)) for own in tasks for out in N._meet(N.prefix_bits(n))(iter(own)) for a, b in zip(out.column("a").to_pylist(), out.column("b").to_pylist())]
        root = dict(N.spanning(*zip(*links)))
        assert all(root.get(a, a) == root.get(b, b) for a, b in met)


def test_texts_that_share_a_hash(spark, monkeypatch):
    """Different texts of one hash stay apart."""
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e f"), (3, "a b c"), (4, None)], "doc_id long, text string")
    monkeypatch.setattr(N.F, "xxhash64", lambda *c, real=N.F.xxhash64: N.F.lit(5).cast("long") if len(c) == 1 else real(*c))
    names = {r.doc_id: r.t for r in N.named(docs, "text").collect()}
    assert names[1] == names[3] and len({names[i] for i in (1, 2, 4)}) == 3
