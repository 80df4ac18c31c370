"""The queries that SQL can express, against that SQL on the smallest tables."""

import duckdb
import pytest

from strandline.llm import catalogue

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df, rel = catalogue.queries()[name](spark, SF), con.sql(catalogue.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    order = [rel.columns.index(c) for c in columns]
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, (tuple(r[k] for k in order) for r in rel.fetchall())))
