"""Every catalog query against its SQL on the smallest driver tables."""

import math
import os

import duckdb
import pytest

from cornice.plans import catalog, governance, identifiers, pages, tables  # noqa: F401  (registers its queries)

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def canon(rows):
    def one(x):
        if x is None or isinstance(x, float) and math.isnan(x):
            return None
        return round(x, 6) if isinstance(x, float) else x

    return sorted((tuple(map(one, r)) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = canon(tuple(r[c] for c in cols) for r in df.collect())
    rel = duck.sql(catalog.ORACLE[name])
    assert sorted(rel.columns) == cols
    want = canon(tuple(dict(zip(rel.columns, r))[c] for c in cols) for r in rel.fetchall())
    assert got == want
