import os

import duckdb
import pytest

from gapweave.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf_dir, name, size):
    at = os.path.join(os.path.dirname(sf_dir), size)
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{at}/{table}.parquet'")
    sql = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, at)
    names = sorted(got.columns)
    assert names == sorted(sql.columns)
    rows = lambda xs: sorted(tuple(repr(x[n]) for n in names) for x in xs)
    assert rows(r.asDict() for r in got.collect()) == rows(dict(zip(sql.columns, r)) for r in sql.fetchall())
