"""Every query of the library beside its SQL, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from leadmill.plans import queries as plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    return c


def plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(plans.ORACLE))
def test_oracle(spark, con, data, name):
    df = plans.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    found = con.execute(plans.ORACLE[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLE)))
def test_runs(spark, data, name):
    assert plans.QUERIES[name](spark, data).count() >= 0


def test_contract(spark):
    assert contract.entry(spark).count() >= 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
