"""The whole pipeline against plain Python over the small tables."""

import re
import unicodedata
from collections import defaultdict

import corpus_pipeline as P
from cladeframe.llm import quality as Q
from tests.conftest import SF
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_line_dedup import brute as line_brute
from tests.llm.test_mixing import brute as mix_brute
from tests.llm.test_near_copies import brute as one_of_each
from tests.llm.test_quality import WORD, base

S = " \t\n\x0b\x0c\r"
java = lambda p: p.replace(r"\z", r"\Z")


def facts(line):
    x = line.strip(S)
    n, low = len(WORD.findall(x)), x.lower()
    marks, shouts = len(re.findall(Q.SYMBOLS, x)), len(re.findall(Q.SHOUT, x))
    upper = sum(unicodedata.category(c) == "Lu" for c in x)
    ends = bool(re.search(java(Q.SENTENCE_END), x))
    fails = x != "" and bool(
        (marks >= 3 and 2 * marks > n) or (shouts >= 3 and 2 * shouts > n) or (2 * upper > len(x) and n >= 3) or len(re.findall(Q.SEPARATORS, x)) >= 3
        or (len(x) <= Q.MENU_CHARS and re.search(java(Q.MENU), low)) or (n >= Q.LIST_WORDS and not ends and not re.search(java(Q.FUNCTION_WORD), low)) or (len(x) <= Q.NOTICE_CHARS and re.search(java(Q.NOTICE), low))
    )
    return fails, 0 < n < Q.PROSE_WORDS and not ends and not re.search(Q.ITEM, x)


def cleaned(text):
    lines = text.split("\n")
    known = [facts(x) for x in lines]
    gone = {i for i, (fails, _) in enumerate(known) if fails}
    for i in range(len(lines) - Q.RUN + 1):
        if all(short for _, short in known[i : i + Q.RUN]):
            gone.update(range(i, i + Q.RUN))
    return "\n".join(x for i, x in enumerate(lines) if i not in gone)


def plain_pipeline(rows, items):
    docs = {}
    for i, t, source in rows:
        kept = cleaned(t)
        if not base(t)[-1] and 2 * (len(t) - len(kept)) <= len(t):
            docs[i] = (kept, source)
    lines = line_brute(sorted((i, t) for i, (t, _) in docs.items()))
    docs = {i: (lines[i][0], s) for i, (_, s) in docs.items() if not lines[i][1] or WORD.search(lines[i][0])}
    docs = {i: docs[i] for i in one_of_each([(i, t) for i, (t, _) in docs.items()])}
    bad = {d for d, _, hit, _ in contaminated([(i, t) for i, (t, _) in docs.items()], items) if hit}
    docs = {i: x for i, x in docs.items() if i not in bad}
    out = defaultdict(int)
    for i, size, _, _, taken in mix_brute([(i, t, s) for i, (t, s) in docs.items()]):
        out[i] = taken
    return {i: (docs[i][0], taken) for i, taken in out.items() if taken}


def test_pipeline(spark):
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(*c).collect()]
    want = plain_pipeline(read("documents", "doc_id", "text", "source"), read("benchmark", "item_id", "text"))
    got = P.run(spark, SF).collect()
    taken = defaultdict(int)
    for r in got:
        taken[r.doc_id] += r.words
        size = len(WORD.findall(want[r.doc_id][0]))
        assert r.text == (want[r.doc_id][0] if r.words == size else " ".join(WORD.findall(want[r.doc_id][0])[: r.words]))
    assert dict(taken) == {i: n for i, (_, n) in want.items()}


def test_stages_take_edges(spark, edge_docs, no_docs):
    """Nulls, repeats and empty tables pass every stage; all but the last keep the columns."""
    for docs in (edge_docs, no_docs):
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            assert out.columns[: len(docs.columns)] == docs.columns, name
            assert out.count() <= 2 * docs.count()


def test_columns_of_any_name_are_kept(spark):
    """Columns called like those that operators use inside pass every stage but the last unchanged."""
    say = lambda k: " ".join(f"the word{k}x{i} and" for i in range(40)) + "."
    lines = "\n".join(say(i) for i in range(3))
    names = "__removed lines_removed line_lines_removed removed row words k1 term pos".split()
    docs = spark.createDataFrame([(i, t, "s", *[i] * len(names)) for i, t in enumerate([lines, say(7) + "\n" + lines, say(9)])], f"doc_id long, text string, source string, {', '.join(n + ' long' for n in names)}")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert all(r[n] == r.doc_id for r in out.collect() for n in names), name
    assert {r.doc_id: r.text for r in P.line_dedup(spark, docs, SF).collect()} == {0: lines, 1: say(7), 2: say(9)}
