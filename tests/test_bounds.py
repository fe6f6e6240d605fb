"""Positions on the very bounds, where a sum of two doubles may fall on either side, against the SQL."""

from datetime import datetime, timedelta

import duckdb
import pandas as pd
import pytest

from paceline.plans.catalogue import ORACLE, QUERIES


@pytest.fixture(scope="module")
def sf_dir(tmp_path_factory):
    there = tmp_path_factory.mktemp("bounds")
    values = [(2.0, 3.0), (60.0, 120.0), (119.99, 119.99), (120.0, 5.0), (120.01, 120.01), (0.0, 0.0), (30.0, 40.0)]  # latitude, longitude
    rows = [(2 * h + k, datetime(2024, 1, 1) + timedelta(hours=h, minutes=k), 20, name, pair[k], '{"k": 1}') for h, pair in enumerate(values) for k, name in enumerate(("signup", "error"))]
    df = pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type", "value", "props"])
    df["ts"] = df["ts"].astype("datetime64[us]")
    df.to_parquet(there / "events.parquet")
    return str(there)


def check(spark, sf_dir, name):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{sf_dir}/events.parquet'")
    want = c.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    value = lambda r: [repr(x) for x in r]
    assert sorted(map(value, QUERIES[name](spark, sf_dir).select(*columns).collect())) == sorted(map(value, want.fetchall()))


def test_jump_outliers(spark, sf_dir):
    check(spark, sf_dir, "jump_outliers")


def test_quality_score(spark, sf_dir):
    check(spark, sf_dir, "quality_score")


def test_range_null_out(spark, sf_dir):
    check(spark, sf_dir, "range_null_out")


def test_quality_score_on_the_border_of_a_rating(spark, tmp_path):
    # for each user hours, jumps, hours without a position, which count as out of bounds: scores of 0.4 and, last, 0.6
    cases = [(44, 2, 7), (76, 2, 19), (88, 4, 14), (87, 1, 2)]
    rows = []
    for user, (n, jumps, without) in enumerate(cases):
        for h in range(n):
            latitude = 50.0 + 30 * (min(h, jumps) % 2)
            values = {"click": 1.0} | ({"signup": latitude, "error": 50.0} if h < n - without else {})
            rows += [(datetime(2024, 1, 1) + timedelta(hours=h, minutes=k), user, name, value, '{"k": 1}') for k, (name, value) in enumerate(values.items())]
    df = pd.DataFrame(rows, columns=["ts", "user_id", "event_type", "value", "props"])
    df.insert(0, "event_id", range(len(df)))
    df["ts"] = df["ts"].astype("datetime64[us]")
    df.to_parquet(tmp_path / "events.parquet")
    check(spark, str(tmp_path), "quality_score")
