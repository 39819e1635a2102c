"""Every registered query against its SQL in DuckDB, whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from pursefold.oracles import ORACLES
from pursefold.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "double": "DOUBLE",
}

# Row counts known at sf0.01.
ROWS = {
    "latest_profile": 150, "profile_merge_newer": 150, "age_histogram": 4945,
    "transaction_status_counts": 2, "first_last_payment": 150, "first_last_activity": 150,
    "argmax_keep_ties": 1507, "payment_merge_fold": 150, "payment_merge_either": 150,
    "payment_fold_keep_ties": 1501, "activity_merge_fold": 150, "activity_merge_either": 150,
    "user_apps": 1495, "user_apps_merge": 1495, "user_apps_new": 220,
    "user_payment_sources": 1049, "user_payment_sources_merge": 1049,
    "user_payment_sources_new": 121, "promotion_expiry": 60000,
    "promotion_expiry_voucher_min": 60000, "promotion_status": 57357,
    "promotion_merge_overwrite": 51731, "voucher_update": 45832, "arrivals": 42,
    "stage_counts": 3,
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query(spark, duck, name):
    got = driver.queries()[name](spark, SF_DIR)
    columns = sorted(got.columns)
    wanted = duck.sql(driver.oracle_sql()[name]).select(*columns)
    kinds = dict(got.dtypes)
    assert [SPARK_TYPES[kinds[c]] for c in columns] == [str(t) for t in wanted.types]
    rows = [tuple(row) for row in got.select(*columns).collect()]
    if SF_DIR.endswith("sf0.01") and name in ROWS:
        assert len(rows) == ROWS[name]
    assert rows
    assert in_order(rows) == in_order(wanted.fetchall())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
