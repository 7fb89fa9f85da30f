"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from marquee.plans.queries import ORACLE, QUERIES
from tests.conftest import SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return ""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return str(v)


def _rows(records, cols):
    return sorted(tuple(_norm(r[c]) for c in cols) for r in records)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_known_non_sql():
    missing = set(QUERIES) - set(entry.oracle_sql())
    assert missing == {"als_user_top10"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    got = [r.asDict() for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = [dict(zip(cols, r)) for r in res.fetchall()]
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _rows(got, sorted(cols)) == _rows(want, sorted(cols))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["genre", "rank", "mid", "avg_score"]
    assert df.count() > 0
