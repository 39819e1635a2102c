import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pursefold.operators.merge import merge_vouchers
from pursefold.plans import promotion
from pursefold.schemas import VOUCHER
from tests.frames import column, rows, ts

PROMO = "user_id bigint, voucher_code string, status string, campaign_id bigint, time_s bigint"
CAMP = "campaign_id bigint, campaign_type int, expire_date timestamp, expire_secs bigint"
DAY = 86400
START = 1_609_459_200  # 2021-01-01


def promos(spark, *items):
    return spark.createDataFrame(list(items), PROMO)


@pytest.fixture(scope="module")
def campaigns(spark):
    return spark.createDataFrame(
        [
            (1, 1, ts("2021-02-01 00:00:00"), 5 * DAY),
            (2, 2, ts("2021-02-01 00:00:00"), 10 * DAY),
            (3, 2, ts("2021-01-05 00:00:00"), None),
            (4, 2, None, DAY),
        ],
        CAMP,
    )


@pytest.fixture(scope="module")
def random_promos(spark):
    rng = random.Random(3)
    data = [
        (
            rng.choice([None, *range(6)]),
            rng.choice([None, *[f"v{n}" for n in range(40)]]),
            rng.choice("AB"),
            rng.choice([1, 2, 3, 4, 9, None]),
            rng.choice([None, *[START + n * DAY for n in range(-20, 40)]]),
        )
        for _ in range(600)
    ]
    return promos(spark, *data)


def test_unknown_and_missing_campaigns_drop_out(spark, campaigns):
    df = promos(spark, (1, "a", "S", 1, START), (1, "b", "S", 9, START), (1, "c", "S", None, START))
    got = promotion.promotion_with_campaign(df, campaigns)
    assert rows(got, "voucher_code", "voucher_expire") == [("a", ts("2021-01-06 00:00:00"))]


def test_status_is_distinct_and_dated(spark, campaigns):
    df = promos(
        spark,
        (1, "a", "S", 2, START), (1, "b", "S", 2, START),
        (1, "c", "S", 2, START + 10 * DAY), (1, "d", "U", 4, START),
    )
    got = promotion.promotion_status(df, campaigns, "2021-01-15")
    assert rows(got) == [(1, 2, "S", False), (1, 2, "S", True), (1, 4, "U", None)]


def test_update_takes_the_latest_claim_and_overwrites(spark, campaigns):
    state = spark.createDataFrame(
        [(1, 2, "OLD", True), (2, 1, "KEPT", True)],
        "user_id bigint, campaign_id bigint, status string, expired boolean",
    )
    df = promos(
        spark,
        (1, "a", "S", 2, START), (1, "b", "T", 2, START + 10 * DAY),
        (3, "x", "P", 1, START), (3, "y", "Q", 1, START), (None, "z", "R", 1, START),
    )
    got = promotion.promotion_update(state, df, campaigns, "2021-01-15")
    assert rows(got) == [(1, 2, "T", False), (2, 1, "KEPT", True), (3, 1, "Q", False)]
    assert rows(promotion.promotion_update(got, df, campaigns, "2021-01-15")) == rows(got)


def test_voucher_min_spans_campaigns_and_leaves_claims_without_code(spark, campaigns):
    df = promos(
        spark,
        (1, "v", "S", 1, START), (1, "v", "S", 2, START),
        (1, None, "S", 2, START), (2, None, "S", 2, START),
    )
    joined = promotion.promotion_with_campaign(df, campaigns)
    claims = promotion.actual_expiry(promotion.voucher_expiry_min(joined))
    five, ten = ts("2021-01-06 00:00:00"), ts("2021-01-11 00:00:00")
    assert rows(claims, "voucher_code", "campaign_id", "voucher_expire", "actual_expire") == [
        ("v", 1, five, ts("2021-02-01 00:00:00")), ("v", 2, five, five),
        (None, 2, ten, ten), (None, 2, ten, ten),
    ]


def test_merge_vouchers_keeps_latest_row_and_earliest_expiry(spark):
    shape = VOUCHER.ddl
    old = spark.createDataFrame([("v", "1", 1, "A", 10, ts("2021-01-01 00:00:00"))], shape)
    new = spark.createDataFrame(
        [
            ("v", "1", 1, "B", 20, ts("2021-03-01 00:00:00")),
            ("v", "1", 2, "C", 20, None),
            ("w", "1", 1, "D", None, None),
            (None, "1", 1, "E", 1, None),
            (None, "1", 1, "F", 1, None),
        ],
        shape,
    )
    merged = merge_vouchers(old, new)
    assert rows(merged) == [
        ("v", "1", 2, "C", 20, ts("2021-01-01 00:00:00")),
        ("w", "1", 1, "D", None, None),
    ]
    assert rows(merge_vouchers(merged, new)) == rows(merged)


def window_form(base, update, campaigns):
    """The same result step by step, with windows over whole vouchers."""
    by_voucher = Window.partitionBy("voucher_code")

    def claims(df, earliest):
        df = promotion.promotion_with_campaign(df, campaigns).filter("voucher_code is not null")
        if earliest:
            df = df.withColumn("voucher_expire", F.min("voucher_expire").over(by_voucher))
        return promotion.actual_expiry(df).select(*VOUCHER.names)

    newest = by_voucher.orderBy(
        *[F.col(c).desc() for c in ("time_s", "campaign_id", "user_id", "status")]
    )
    return (
        claims(base, True)
        .unionByName(claims(update, False))
        .withColumn("actual_expire", F.min("actual_expire").over(by_voucher))
        .withColumn("n", F.row_number().over(newest))
        .filter("n = 1")
        .drop("n")
    )


def test_voucher_update_equals_window_form(random_promos, campaigns):
    base = random_promos.filter("status = 'A'")
    update = random_promos.filter("status = 'B'")
    wanted = rows(window_form(base, update, campaigns))
    got = promotion.voucher_update(base, update, campaigns)
    assert rows(got) == wanted
    state = merge_vouchers(
        promotion.voucher_claims(base, campaigns, min_per_voucher=True).limit(0),
        promotion.voucher_claims(base, campaigns, min_per_voucher=True),
    )
    assert rows(promotion.voucher_merge(state, update, campaigns)) == wanted
