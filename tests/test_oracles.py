"""Every query with an SQL twin, against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from forelight.registry import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    if isinstance(v, (int, float)) or hasattr(v, "dtype"):
        x = round(float(v), 4) + 0.0
        return str(int(x)) if x.is_integer() else repr(x)
    return str(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_its_sql(spark, sf_dir, duck, name):
    got, want = QUERIES[name](spark, sf_dir).toPandas(), duck.execute(ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = [sorted(tuple(map(plain, r)) for r in df[columns].itertuples(index=False)) for df in (got, want)]
    assert rows[0] == rows[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
