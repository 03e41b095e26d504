"""Every registered query against its independent SQL statement (DuckDB)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_mod
from layerworks.plans.queries import QUERIES as BASE

from .conftest import SF_SMALL

TABLES = ("lineitem", "part", "supplier", "orders")
QUERIES = {k: v for k, v in entry_mod.queries().items() if k in BASE}
ORACLE = {k: v for k, v in entry_mod.oracle_sql().items() if k in BASE}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df):
    cols = sorted(df.columns)
    out = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert len(QUERIES) == 54


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns[:2] == ["movie_key", "rated_month"]
    assert df.count() > 0


def test_schema_report_lists_silver(spark):
    rep = QUERIES["schema_report"](spark, SF_SMALL).collect()
    names = [r.column_name for r in rep]
    assert names[:4] == ["user_id", "movie_id", "rating", "event_ts"]
    assert [r.position for r in rep] == list(range(1, len(rep) + 1))
