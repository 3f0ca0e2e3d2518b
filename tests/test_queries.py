"""Every registered query against its oracle SQL in DuckDB, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from sourceloom.plans.queries import ORACLES, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return con


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    frame = frame.astype(object).where(frame.notna(), None)
    plain = lambda x: round(x, 9) if isinstance(x, float) else (x.item() if hasattr(x, "item") else x)
    return list(frame.columns), sorted(tuple(repr(plain(x)) for x in row) for row in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, data, duck, name):
    got = rows_of(QUERIES[name](spark, data).toPandas())
    want = rows_of(duck.sql(ORACLES[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) > 0
    assert got[1] == want[1]


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 6


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
