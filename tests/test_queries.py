"""Each panel query against its SQL in DuckDB."""

import os

import duckdb
import pandas as pd
import pytest

from lotmetrics.plans import catalog

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DIR}/{f}'")
    got, want = catalog.QUERIES[name](spark, DIR).toPandas(), con.execute(catalog.ORACLE[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    both = []
    for df in (got, want):
        df = df[columns].astype({c: "float64" for c in columns if df[c].dtype.kind in "iufb" or str(df[c].dtype).startswith("Int")})
        order = [c for c in columns if df[c].dtype.kind not in "f"] + [c for c in ("place", "idx", "lag", "id", "polygon", "quarter", "first", "o_custkey", "user_id", "event", "flagged") if c in columns]
        both.append(df.sort_values(list(dict.fromkeys(c for c in [*order, "target", "h", *columns] if c in columns))).reset_index(drop=True))
    pd.testing.assert_frame_equal(*both, check_dtype=False, rtol=1e-9, atol=2e-6)
