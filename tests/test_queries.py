"""Every registered query against its SQL on the smallest data set."""

import datetime
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from catalog.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if value is None or value is pd.NA or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (pd.Timestamp, datetime.datetime)):
        return pd.Timestamp(value).isoformat()
    return value.item() if hasattr(value, "item") else value


def rows(frame):
    columns = sorted(frame.columns)
    values = [tuple(plain(v) for v in r) for r in frame[columns].astype(object).itertuples(index=False, name=None)]
    return columns, sorted(values, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    assert name in driver.oracle_sql()
    got = rows(driver.queries()[name](spark, SF).toPandas())
    want = rows(duck.execute(driver.oracle_sql()[name]).fetchdf())
    assert got == want


def test_entry(spark):
    assert driver.entry(spark).count() > 0
