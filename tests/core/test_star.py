"""Registered queries run and have the columns that their SQL names; those without SQL give rows."""

import duckdb
import pytest
from cladeframe.plans import star
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return str(v)
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    try:
        f = float(v)
        return repr(int(f) if f == int(f) else f)
    except (TypeError, ValueError):
        return str(v)


@pytest.mark.parametrize("name", ["group_expression", "mapping_quality", "function_expression_drop", "best_run", "refresh_decisions", "marker_coverage", "vote_summary", "lineages", "subset_counts", "trait_pairs", "phylogenetic_blocks", "monophyly", "batches", "pilot_items", "common_ancestors"])
def test_matches_sql(spark, engine, name):
    df = star.QUERIES[name](spark, SF)
    result = engine.execute(star.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    at = [names.index(c) for c in sorted(names)]
    want = sorted(tuple(plain(r[i]) for i in at) for r in result.fetchall())
    assert sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(star.QUERIES) - set(star.SQL)))
def test_runs(spark, name):
    assert star.QUERIES[name](spark, SF).count() > 0


def test_order_and_partitions_do_not_matter(spark):
    from cladeframe.operators import expression

    a, m = star.abundance(spark, SF), star.brands(spark, SF)
    one = expression.group_expression(a.coalesce(1), m).orderBy("sample", "orthogroup").collect()
    assert one == expression.group_expression(a.repartition(32), m.repartition(5)).orderBy("sample", "orthogroup").collect()
