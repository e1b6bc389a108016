import hashlib
import math
import re
from collections import defaultdict

from cladeframe.llm.mixing import mix_assignments, mix_documents
from tests.conftest import SF


def brute(rows, weights=(3, 1, 2), share=1.5, epochs=2, seed="mix"):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted({s for _, _, s in rows if s is not None}) + [None] * any(s is None for _, _, s in rows)
    total = {n: sum(size(t) for _, t, s in rows if s == n) for n in names}
    weight = {n: float(weights[i % len(weights)]) for i, n in enumerate(names)}
    target, free, left = {}, set(names), share * sum(total.values())
    while free:
        level = left / sum(weight[n] for n in free)
        over = {n for n in free if level * weight[n] > epochs * total[n]}
        if not over:
            target |= {n: level * weight[n] for n in free}
            break
        for n in over:
            target[n] = float(epochs * total[n])
        left -= sum(target[n] for n in over)
        free -= over
    out = []
    for n in names:
        own = defaultdict(list)
        for i, t, s in rows:
            if s == n:
                own[hashlib.md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest()].append((i, size(t)))
        whole = min(epochs, int(target[n] // total[n])) if total[n] else 0
        rest = math.floor(target[n]) - whole * total[n]
        for k in sorted(own):
            here = sum(z for _, z in own[k])
            for i, z in own[k]:
                part = z if here <= rest else rest * z // here
                out.append((i, z, total[n], round(target[n], 6), whole * z + part))
            rest = max(0, rest - here)
    return sorted(out, key=str)


def got(df):
    return sorted(((r[0], r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=str)


def test_edges(edge_docs, edge_rows):
    rows = [(r[0], r[1], r[3]) for r in edge_rows]
    for share in (1.5, 0.3, 2.0):
        want = brute(rows, share=share)
        have = got(mix_assignments(edge_docs, share=share))
        assert [x[:4] for x in have] == [x[:4] for x in want]
        assert all(abs(a[4] - b[4]) <= 0 for a, b in zip(have, want))


def test_empty(no_docs):
    assert mix_assignments(no_docs).count() == 0
    assert mix_documents(no_docs).count() == 0


def test_near_targets_and_reruns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = mix_assignments(docs).collect()
    by = defaultdict(int)
    for r in out:
        by[r.source_size, r.target] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    assert all(abs(v - t) < 2 for (_, t), v in by.items() if [*by].count(_) <= 1)
    assert got(mix_assignments(docs.repartition(9))) == got(mix_assignments(docs.coalesce(1)))


def test_documents(edge_docs, edge_rows):
    rows = [r for r in edge_rows if r[0] is not None]
    plan = mix_assignments(edge_docs)
    mixed = mix_documents(edge_docs)
    assert mixed.columns == [*edge_docs.columns, "epoch", "words"]
    assert mixed.agg({"words": "sum"}).first()[0] == plan.agg({"taken": "sum"}).first()[0]
    assert all(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) == r.words for r in mixed.collect())
    assert len(rows) < len(edge_rows)


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 9)], "doc_id long, text string, source string, words int")
    assert mix_documents(docs).columns == ["doc_id", "text", "source", "words", "epoch", "mix_words"]
