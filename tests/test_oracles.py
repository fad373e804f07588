"""Every registered query with an oracle: Spark vs DuckDB on sf0.001."""

import pytest

from conftest import SF_SMALL
import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_key

_SQL = E.oracle_sql()
_Q = E.queries()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(_SQL))
def test_query_matches_oracle(spark, duck, name):
    df = _Q[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(_SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_key(df.columns, srows) == rows_key(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["user_id", "win_start"]
