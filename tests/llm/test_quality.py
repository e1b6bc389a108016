import re
from collections import Counter

from cladeframe.llm.quality import cleaned_text, judged, keep_good
from cladeframe.llm.queries import op3_quality_rules
from pyspark.sql import functions as F
from tests.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


def test_edges(edge_docs, edge_rows):
    out = judged(edge_docs).collect()
    assert len(out) == len(edge_rows)
    got = sorted((str(r.row.doc_id), r.row.text or "", r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out)
    assert got == sorted((str(r[0]), r[1] or "", *base(r[1])) for r in edge_rows)
    assert keep_good(edge_docs).columns == edge_docs.columns


def test_empty(no_docs):
    assert judged(no_docs).count() == 0


def test_lines(spark):
    prose = " ".join(f"word{i}" for i in range(60)) + "."
    bad = ["Home | News | Sport | Weather", "We use cookies on this site.", "Share", "BUY NOW!! BEST PRICES!! TODAY!!", "#a ***b $$$c %%%d"]
    docs = spark.createDataFrame([(1, prose + "\n" + "\n".join(bad)), (2, prose.replace(" ", " | ")), (3, prose.upper()), (4, prose)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in keep_good(docs).collect()) == [(1, prose), (4, prose)]


def test_query_keeps_clean(spark):
    docs = dict(map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()))
    good = dict((r.doc_id, r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect())
    out = op3_quality_rules(spark, SF).collect()
    assert len(out) == len(docs)
    for r in out:
        assert tuple(r)[1:7] == base(docs[r.doc_id])
    judged_good = [r for r in out if good.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(r.kept for r in judged_good) >= 0.99 * len(judged_good)


def test_words_of_notices_in_prose(spark):
    """Texts about cookie dough, a JavaScript engine and a changed privacy policy keep their lines; notices lose theirs."""
    prose = [
        "The cookie dough rests for an hour before it is rolled out and cut.", "She uses cookies and cream in the second layer of the cake.", "The javascript engine compiles hot functions while the page loads.",
        "Readers who subscribe to this theory expect prices to fall next year.", "The court found that the privacy policy of the company was too vague.", "He printed a newsletter on the press in his cellar for twenty years.",
        "The terms of use were changed twice before the contract was signed.", "If you click here and there in the old program it stops at once.",
    ]
    notices = [
        "We use cookies to improve your experience.", "This website uses necessary cookies.", "Please enable JavaScript to view this page.", "JavaScript is disabled in your browser.", "All rights reserved.", "Subscribe to our newsletter!", "Sign up for our weekly newsletter.",
        "Click here for more.", "Privacy policy", "Accept all cookies", "Diese Webseite verwendet Cookies.", "Alle Rechte vorbehalten.", "Lorem ipsum dolor sit amet.",
    ]
    docs = spark.createDataFrame([(1, "\n".join(prose)), (2, "\n".join(notices))], "doc_id long, text string")
    got = {r.doc_id: r.t for r in docs.select("doc_id", cleaned_text(F.col("text")).alias("t")).collect()}
    assert got[1].split("\n") == prose and got[2] == ""
    assert judged(spark.createDataFrame([(1, "\n".join(prose))], "doc_id long, text string")).first().kept
