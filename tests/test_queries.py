import math
from collections import Counter

import duckdb
import pytest

from clearwell.catalogue import ORACLE_SQL, QUERIES
from clearwell.sources.views import TABLES

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name in ORACLE_SQL:
        result = duck.execute(ORACLE_SQL[name])
        own = [x[0] for x in result.description]
        assert sorted(own) == columns
        assert got == Counter(tuple(plain(dict(zip(own, r, strict=True))[c]) for c in columns) for r in result.fetchall())
    else:
        assert got
