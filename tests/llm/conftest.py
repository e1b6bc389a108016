import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k1 string, k2 string, row int, size string, `key` string, h1 int, id string"


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows and columns with clashing names."""
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)] + ["é" + str(i) for i in range(40)]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passage = say(60)
    lines = "\n".join(say(7) + "." for _ in range(6))
    texts = [None, "", "   ", "one", "two words", say(34), say(35), passage, passage, f"{say(20)} {passage} {say(9)}", f"{passage} {say(3)} {passage}", lines, lines + "\nlast line.", "intro\n" + lines, say(6000), lines.upper(), "a\n\n\nb\nc\nd", "x " * 80, "\x85a b c \x1f d", say(300), "dup " + say(50)]
    rows = [(i, t, "en", f"src{i % 3}", len(t or ""), "a", "b", 1, "s", "q", 2, "z") for i, t in enumerate(texts)]
    rows += [rows[19], rows[20], rows[20], rows[9]]
    rows += [(None, say(80), None, None, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None, None, None), (7, say(50), "en", None, 1, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
