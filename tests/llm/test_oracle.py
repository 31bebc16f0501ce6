"""The numbered queries beside their SQL, on the smallest tables."""

import duckdb
import pytest

from leadmill.llm import entries

TABLES = ("documents", "pages", "benchmark", "conversations")


@pytest.mark.parametrize("name", sorted(entries.ORACLE_SQL))
def test_oracle(spark, data, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    df = entries.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    found = con.execute(entries.ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    want = sorted(tuple(str(r[names.index(c)]) for c in columns) for r in found.fetchall())
    assert sorted(names) == columns and sorted(tuple(map(str, r)) for r in df.select(*columns).collect()) == want
