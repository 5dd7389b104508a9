"""Every registered query against DuckDB on the smallest driver tables."""

import decimal
import math
import os

import duckdb
import pytest

from keyferry.queries import ORACLES, QUERIES
from keyferry.queries.base import TABLES

DIR = os.environ.get("KEYFERRY_SF_DIR", "/root/testdata/sf0.001")
SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if math.isnan(v) else round(float(v), 6)
    return v


@pytest.mark.skipif(not os.path.isdir(DIR), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(quick, duck, name):
    df = QUERIES[name](quick, DIR)
    cur = duck.execute(ORACLES[name])
    cols = sorted(df.columns)
    names = [c[0] for c in cur.description]
    assert cols == sorted(names)
    kinds = {c[0]: str(c[1]) for c in cur.description}
    assert {c: SPARK_TYPES[t] for c, t in df.dtypes} == kinds
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall()), key=repr)
    assert got == want
