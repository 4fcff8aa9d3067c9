"""Every query with SQL gives the rows that DuckDB gives."""

import duckdb
import pytest

from lodestone import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_same_rows(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    rows, found = df.collect(), duck.execute(plans.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    mine = sorted(repr([r[c] for c in sorted(names)]) for r in rows)
    assert mine == sorted(repr([r[names.index(c)] for c in sorted(names)]) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLES)))
def test_rows_only(spark, name):
    assert plans.QUERIES[name](spark, SF).count() > 0
