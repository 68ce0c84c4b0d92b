"""Every query with SQL against DuckDB, the others for rows; on the smallest tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

from tessera import catalog
from tests.conftest import SF


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, (int, str)):
        return v
    return "nan" if math.isnan(float(v)) else round(float(v), 8)


SLOW = {"gbt_scores", "bucket_sample", "multiview_topk", "countsketch_topk", "ivf_topk"}


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in SLOW])
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    rows = df.collect()
    if name in catalog.ORACLE_SQL:
        found = duck.execute(catalog.ORACLE_SQL[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == sorted(df.columns)
        want = Counter(tuple(plain(r[names.index(c)]) for c in df.columns) for r in found.fetchall())
        assert Counter(tuple(plain(x) for x in r) for r in rows) == want


def test_entry_and_optional_package(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
