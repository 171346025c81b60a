"""Every query of the subpackage that has SQL gives the SQL's rows at the smallest scale."""

import duckdb
import pytest

from voxloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLE_SQL[name])
    columns = sorted(want.columns)
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == sorted(repr(tuple(r[k] for k in at)) for r in want.fetchall())
