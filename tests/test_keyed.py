import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pursefold.operators.keyed import (
    first_last_by_key,
    keep_last_ties,
    latest_by_key,
    seed_first_last,
    split_null_keys,
    with_group_min,
)
from tests.frames import rows, spans, ts


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 7 holds a third of the rows and most of them stand at one time; some keys are NULL."""
    rng = random.Random(5)
    data = []
    for i in range(3000):
        key = 7 if i % 3 == 0 else None if i % 50 == 1 else rng.randrange(400)
        second = 500 if key == 7 and i % 2 == 0 else rng.randrange(500 if key == 7 else 60)
        data.append((key, None if i % 97 == 5 else second, rng.randrange(4)))
    df = spark.createDataFrame(data, "user_id bigint, s int, attr int")
    return df.select(
        "user_id", F.timestamp_seconds(F.lit(1_600_000_000) + F.col("s")).alias("t"), "attr"
    ).repartition(6)


def test_keep_last_ties_equals_window_form(skewed):
    events = seed_first_last(skewed, "user_id", "t", "attr", "first", "last", "attr")
    by_user = Window.partitionBy("user_id")
    wanted = (
        events.filter("user_id is not null")
        .withColumn("f", F.min("first").over(by_user))
        .withColumn("m", F.max("last").over(by_user))
        .filter("last = m")
        .select("user_id", F.col("f").alias("first"), "last", "attr")
    )
    got = keep_last_ties(events, "user_id", "first", "last")
    assert got.columns == wanted.columns
    assert rows(got) == rows(wanted)
    assert got.filter("user_id = 7").count() > 400


def test_with_group_min_equals_window_form(skewed):
    low = F.min("t").over(Window.partitionBy("user_id"))
    wanted = skewed.withColumn("t", F.when(F.col("user_id").isNull(), F.col("t")).otherwise(low))
    assert rows(with_group_min(skewed, "user_id", "t")) == rows(wanted)


def test_rows_of_a_hot_key_are_split(spark, skewed):
    """However many rows a key has, adaptive execution deals them to several tasks."""
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for name, value in options.items():
        spark.conf.set(name, value)
    try:
        got = with_group_min(skewed, "user_id", "t")
        got.collect()
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in options:
            spark.conf.unset(name)


def test_latest_by_key_uses_tiebreak_then_other_columns(spark):
    df = spark.createDataFrame(
        [
            (1, ts("2021-01-01 00:00:00"), 1, "a"),
            (1, ts("2021-01-02 00:00:00"), 1, "b"),
            (1, ts("2021-01-02 00:00:00"), 2, "c"),
            (2, None, 9, "d"),
            (2, ts("2020-01-01 00:00:00"), 1, "e"),
            (3, None, None, "f"),
            (4, ts("2020-01-01 00:00:00"), 1, "x"),
            (4, ts("2020-01-01 00:00:00"), 1, "y"),
        ],
        "k int, t timestamp, n int, v string",
    )
    got = latest_by_key(df, ["k"], ["t", "n"])
    assert got.columns == df.columns
    assert rows(got, "k", "v") == [(1, "c"), (2, "e"), (3, "f"), (4, "y")]


def test_latest_by_key_does_not_depend_on_row_order(skewed):
    def best(df):
        return rows(latest_by_key(df, ["user_id"], ["t"]))

    assert best(skewed) == best(skewed.orderBy(F.desc("attr"), "t").coalesce(1))


TXN = "trans_id string, user_id bigint, t timestamp, app int"
NAMES = {"first": "f", "last": "l", "last_attr": "a"}


def test_first_last_ties(spark):
    df = spark.createDataFrame(
        [
            ("a", 1, ts("2021-01-01 00:00:00"), 1),
            ("b", 1, ts("2021-01-03 00:00:00"), 9),
            ("c", 1, ts("2021-01-03 00:00:00"), 2),
            ("d", 2, None, 3),
            ("e", None, ts("2021-01-03 00:00:00"), 4),
        ],
        TXN,
    )
    first, last = ts("2021-01-01 00:00:00"), ts("2021-01-03 00:00:00")
    one = first_last_by_key(df, "user_id", "t", "app", tiebreak="trans_id", **NAMES)
    assert rows(one) == [(1, first, last, 2)]
    untold = first_last_by_key(df, "user_id", "t", "app", **NAMES)
    assert rows(untold) == [(1, first, last, 9)]
    seeded = seed_first_last(df, "user_id", "t", "app", **NAMES)
    assert rows(keep_last_ties(seeded, "user_id", "f", "l")) == [
        (1, first, last, 2), (1, first, last, 9)
    ]


def test_keep_last_ties_takes_first_from_rows_without_last(spark):
    df = spans(
        spark,
        (1, "2021-01-01 00:00:00", None, 1),
        (1, "2021-01-02 00:00:00", "2021-01-02 00:00:00", 2),
        (2, "2021-01-02 00:00:00", None, 2),
    )
    wanted = [(1, ts("2021-01-01 00:00:00"), ts("2021-01-02 00:00:00"), 2)]
    assert rows(keep_last_ties(df, "user_id", "first", "last")) == wanted


def test_split_null_keys(spark):
    df = spark.createDataFrame([(1, 2), (1, None), (None, 2), (None, None)], "a int, b int")
    full, rejected = split_null_keys(df, ["a", "b"])
    assert rows(full) == [(1, 2)]
    assert rejected.count() == 3
