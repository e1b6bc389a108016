import random

from cladeframe.functions import text as T
from cladeframe.sources.newick import forest, read_forest, state_after, tree_texts
from pyspark.sql import functions as F


def names(df):
    return sorted(r.name for r in df.collect() if r.tin == r.tout and r.name)


def tips_of(spark, text):
    found = forest(spark.createDataFrame([("t", text)], "tree_id string, newick string")).collect()
    return sorted(r.name for r in found if r.name), {r.problem for r in found}


def test_quotes_and_comments(spark, tmp_path):
    (tmp_path / "one.nwk").write_text("('a;b':1,c:2);")
    assert names(read_forest(spark, str(tmp_path / "one.nwk"))) == ["a;b", "c"]
    (tmp_path / "two.nwk").write_text("(A,\n B)\n;\n[first; it's a comment]('it''s; two':1,\n[;]d:2);\n(e,'f[';'g)\n;\n")
    found = {r.number: r.newick for r in tree_texts(spark, str(tmp_path / "two.nwk")).collect()}
    assert found == {0: "(A,\n B)\n;", 1: "\n[first; it's a comment]('it''s; two':1,\n[;]d:2);", 2: "\n(e,'f[';", 3: "'g)\n;\n;"}
    got = read_forest(spark, str(tmp_path / "two.nwk"))
    assert names(got.where("tree_id = 'two#1'")) == ["d", "it's; two"] and {r.problem for r in got.where("tree_id > 'two#1'").collect()} == {"unreadable"}


def test_names_with_spaces_and_loose_ends(spark):
    assert tips_of(spark, "(Plant A:1,b:2);")[1] == {"unreadable"}
    assert tips_of(spark, "('Plant A':1,b:2);") == (["Plant A", "b"], {None})
    assert tips_of(spark, "(A:1,B:2)x;y")[1] == {"unreadable"} and tips_of(spark, "(A:1,'B:2);")[1] == {"unreadable"}


def whole(text):
    """Trees by one pass over the text."""
    out, now, state = [], "", 0
    for c in text:
        if c == ";" and state == 0:
            out.append(now)
            now = ""
            continue
        now += c
        state = state_after(c, state)
    return [t for t in [*out, now] if t.strip()]


def test_blocks_of_a_file(spark, tmp_path):
    """Files read in many small blocks, whose borders fall into quotes and comments."""
    rng = random.Random(2)
    texts = {}
    for k in range(3):
        trees = [f"('{''.join(rng.choice('ab;[] ') for _ in range(rng.randrange(30)))}':1,[{''.join(rng.choice(chr(39) + 'xy;') for _ in range(rng.randrange(30)))}]t{i}:2);" for i in range(150)]
        texts[f"f{k}.nwk"] = "\n".join(trees) + "\n"
        (tmp_path / f"f{k}.nwk").write_text(texts[f"f{k}.nwk"])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = tree_texts(spark, str(tmp_path)).persist()
        assert found.count() == 450
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name, text in texts.items():
        own = [r.newick for r in found.where(F.col("file").endswith(name)).orderBy("number").collect()]
        assert own == [t + ";" for t in whole(text)]


def test_deep_comb(spark):
    """A comb of 20,000 tips: rows and memory follow the nodes."""
    n = 20_000
    text = "(" * (n - 1) + "t0:1" + "".join(f",t{i}:1):1" for i in range(1, n)) + ";"
    from cladeframe.operators.forest import clade_counts

    nodes = forest(spark.createDataFrame([("c", text)], "tree_id string, newick string")).persist()
    assert nodes.count() == 2 * n - 1
    own = spark.range(n).select(F.concat(F.lit("t"), "id").alias("tip"), (F.col("id") % 7).alias("species_id"), (F.col("id") % 2).cast("string").alias("trait"))
    out = clade_counts(nodes, own).join(nodes.select("node_id", "depth", "tin", "tout"), "node_id")
    wrong = out.where("samples <> tout - tin + 1 or species <> least(7, samples) or zero + one <> samples or abs(zero - one) > 1 or missing <> 0")
    assert out.count() == 2 * n - 1 and wrong.count() == 0


def test_gapped_strings(spark):
    def one(*x, protein=False):
        q, t, a, b, c, d, cigar = x
        df = spark.createDataFrame([(q, t, a, b, c, d, cigar)], "q string, t string, a int, b int, c int, d int, cigar string")
        r = df.select(T.gapped(*[F.col(n) for n in ("q", "t", "a", "b", "c", "d", "cigar")], protein=protein).alias("g")).first().g
        return r.problem or (r.query, r.target)

    assert one("AACCG", "AACGG", 1, 5, 1, 5, "2M1I1M1D1M") == ("AACC-G", "AA-CGG")
    assert one("AACG", "AACG", 4, 1, 4, 1, "0M4M") == ("CGTT", "CGTT")
    assert one("AACG", "AACG", 1, 4, 1, 4, "3M") == "coordinates"
    assert one("AACG", "AACG", 1, 4, 1, 4, "4Z") == one("AACG", "AACG", 1, 4, 1, 4, "2M2") == "invalid_cigar"
    assert one("TTAACG", "AACG", 3, 6, 1, 4, "2=1X1=") == ("AACG", "AACG")
    assert one("AAC", "AACG", 1, 4, 1, 4, "4M") == "coordinates"
    assert one("AACG", "AACG", 4, 1, 1, 4, "4M", protein=True) == "reversed_protein"
