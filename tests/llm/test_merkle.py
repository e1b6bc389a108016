import hashlib
import zlib
from collections import defaultdict

from cladeframe.llm.merkle import manifest, proofs, rank_directory, ranked, tampered
from cladeframe.llm.queries import op11_merkle_manifest
from pyspark.sql import functions as F
from tests.conftest import SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def grow(nodes):
    """The levels over nodes, the last of one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def way(levels, i):
    out = []
    for nodes in levels[:-1]:
        a = i // 16 * 16
        out.append(("".join(nodes[a:i]), "".join(nodes[i + 1 : a + 16])))
        i //= 16
    return out


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    sources = defaultdict(list)
    for r in rows:
        sources[r[1]].append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for own in sources.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: grow([leaf(r) for r in sources[s]]) for s in order}
    top, out = grow([trees[s][-1][0] for s in order]), []
    for k, s in enumerate(order):
        for i, r in enumerate(sources[s]):
            path = way(trees[s], i) + way(top, k)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            h = leaf((*r[:4], r[4].translate(LOWER)) if hit and r[4] is not None else r)
            for a, b in path:
                h = digest(a + h + b)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], digest("".join(a + b for a, b in path)), h, h == top[-1][0]))
    return sorted(out, key=repr)


def found(docs):
    rows = proofs(manifest(docs, changed=tampered(docs))).collect()
    return sorted([(r.id, r.leaf, r.subroot, r.root, r.proof, r.folded_root, r.folded_root == r.root) for r in rows], key=repr)


def test_edges(edge_docs, edge_rows):
    """Nulls, repeated rows, and equal ids whose rows differ."""
    want = brute([(r[0], r[3], r[2], r[4], r[1]) for r in edge_rows])
    assert found(edge_docs) == want


def test_sizes(spark):
    """Sources of 1 to 700 rows, ids far apart and below zero, more sources than a node has children, names in byte order."""
    rows = []
    for k, n in enumerate([1, 2, 15, 16, 17, 255, 256, 257, 272, 273, 700, *[1] * 12]):
        name = None if k == 5 else ["é", "z", "Z", "", "a/b", "日本"][k] if k < 6 else f"s{k}"
        rows += [((-1) ** i * i * (10**15 + 7) if k == 7 else i * 67 + k, name, "en", i, f"Text {i}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    want = brute(rows)
    assert found(docs) == want and not all(x[-1] for x in want)


def test_many_equal_ids(spark):
    rows = [(None if i % 2 else 7, "s", None, i // 3, "T") for i in range(900)] + [(8, "s", None, 1, None), (6, "s", None, None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(docs) == brute(rows)


def test_ranks(spark):
    keys = [("a", k, 1 + k % 3) for k in (-(2**63), -1, 0, 1, 63, 64, 70, 2**18, 2**40, 2**63 - 1)] + [("b", 5, 2)]
    rows = spark.createDataFrame(keys, "source string, key long, n long")
    got = {(r.source, r.key): (r.place, r.tied) for r in ranked(rows.select("source", "key"), rank_directory(rows)).collect()}
    want, place = {}, {"a": 0, "b": 0}
    for s, k, n in sorted(keys):
        want[s, k] = (place[s], n - 1)
        place[s] += n
    assert got == want


def test_one_row_and_none(spark, no_docs):
    docs = spark.createDataFrame([(3, "s", "en", 1, "Ab")], "doc_id long, source string, lang string, n_chars long, text string")
    (row,) = proofs(manifest(docs)).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root == leaf((3, "s", "en", 1, "Ab")) and row.proof == digest("")
    tree = manifest(no_docs)
    assert tree.root is None and proofs(tree).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    out = op11_merkle_manifest(spark, SF)
    got = sorted([(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in out.collect()], key=repr)
    assert got == brute(rows)
