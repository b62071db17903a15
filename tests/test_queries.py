"""Every query with SQL gives the same rows as DuckDB; the others give rows."""

import os
from collections import Counter

import duckdb
import numpy as np
import pytest

from opalgrid.plans import registry

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
#: Rows may be absent at the smallest scale.
MAY_BE_EMPTY = {"j06_is_in"}


@pytest.fixture(scope="module")
def oracle(small):
    db = duckdb.connect()
    for t in TABLES:
        path = f"{small}/{t}.parquet"
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return db


def plain(v):
    if v is None or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, (float, np.floating)):
        return f"{float(v):.5f}"
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, dict):
        return tuple(sorted((str(k), plain(x)) for k, x in v.items()))
    return v


@pytest.mark.parametrize("name", registry.QUERIES)
def test_query(spark, small, oracle, name):
    df = registry.QUERIES[name](spark, small)
    columns = sorted(df.columns)
    rows = Counter(tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    if name not in registry.SQL:
        assert rows or name in MAY_BE_EMPTY
        return
    found = oracle.sql(registry.SQL[name])
    assert sorted(found.columns) == columns
    listed = ", ".join(f'"{c}"' for c in columns)
    assert rows == Counter(tuple(map(plain, r)) for r in oracle.sql(f"SELECT {listed} FROM ({registry.SQL[name]})").fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
