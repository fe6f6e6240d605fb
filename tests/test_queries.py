"""Every registered query of the time-series library against its SQL, on the smallest tables."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from paceline.plans.catalogue import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(df):
    value = lambda v: "~" if pd.isna(v) else repr(float(v) + 0.0) if isinstance(v, (int, float, np.number)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(value(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


def test_all_have_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sql, name):
    got, want = QUERIES[name](spark, SF).toPandas(), sql.execute(ORACLE[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
