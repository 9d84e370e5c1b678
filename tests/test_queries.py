"""Every query of the library against its oracle SQL, on the smallest tables."""

import datetime
import decimal
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from tidemark.plans import registry

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or pd.isna(v):
        return None
    if isinstance(v, pd.Timestamp):
        return str(v.tz_localize(None) if v.tz else v)
    if isinstance(v, datetime.date) and not isinstance(v, datetime.datetime):
        return f"{v} 00:00:00"
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, (float, decimal.Decimal)):
        return int(v) if float(v).is_integer() else round(float(v), 5)
    return v


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(repr(tuple(map(plain, r))) for r in df.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, str(DATA)).toPandas()
    if name in registry.ORACLE:
        want = duck.execute(registry.ORACLE[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got)
