import os

import duckdb
import pandas as pd
import pytest

from cratedig.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{t}'")
    want = con.sql(ORACLE_SQL[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    order = lambda df: df[columns].sort_values(columns).reset_index(drop=True)
    pd.testing.assert_frame_equal(order(got), order(want), check_dtype=False, rtol=1e-12)
