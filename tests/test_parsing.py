import datetime as dt

import pytest
from pyspark.sql import functions as F

from pursefold.functions import parsing, rules
from pursefold.operators.audit import parse_losses
from pursefold.operators.cleaning import clean_transactions
from pursefold.schemas import TRANSACTIONS, USERS
from pursefold.sources.tsv import typed
from tests.frames import column, rows, ts


def parsed(spark, parse, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return column(df.select("i", parse(F.col("text")).alias("v")), "v", "i")


def test_status_text(spark):
    texts = ["1", " 1", "01", "1.0", "1.5", "OK", None]
    assert parsed(spark, parsing.to_int, texts) == [1, 1, 1, 1, None, None, None]


def test_times_keep_only_the_second_after_truncation(spark):
    texts = [
        "2021-11-01 10:20:30.987", "2021-11-01 10:20:30", "2021-11-01T10:20:30",
        "2021-11-01 10:20:30.9", "bad", None,
    ]
    got = parsed(spark, lambda t: parsing.to_second(parsing.to_time(t)), texts)
    assert got == [ts("2021-11-01 10:20:30")] * 4 + [None, None]


def test_epoch_from_number_or_time(spark):
    texts = ["1635762030", "2021-11-01 10:20:30.987", "4102444800", "x", None]
    got = parsed(spark, parsing.to_epoch, texts)
    assert got == [1635762030, 1635762030, 4102444800, None, None]


def test_ids_with_leading_zero_are_the_same_number(spark):
    assert parsed(spark, parsing.to_long, ["7", "07", "c7"]) == [7, 7, None]


def test_dates(spark):
    got = parsed(spark, parsing.to_date, ["1990-05-04", "1990-05-04 11:12:13", "04/05/1990"])
    assert got == [dt.date(1990, 5, 4), dt.date(1990, 5, 4), None]


def test_parsing_does_not_fail_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


@pytest.mark.parametrize(
    "as_of, age",
    [("2021-03-09", 20), ("2021-03-10", 20), ("2021-03-11", 21)],
)
def test_age_around_the_twenty_first_birthday(spark, as_of, age):
    df = spark.createDataFrame([(dt.date(2000, 3, 10),)], "birthdate date")
    assert df.select(rules.age_years(F.col("birthdate"), as_of)).first()[0] == age


def test_age_of_unknown_birthdate(spark):
    df = spark.createDataFrame([(None,)], "birthdate date")
    assert df.select(rules.age_years(F.col("birthdate"), "2021-01-01")).first()[0] is None


RULE = "i int, kind int, expire_date timestamp, voucher timestamp"
EARLY, LATE = ts("2021-01-01 00:00:00"), ts("2021-06-01 00:00:00")


def test_expiry_rule(spark):
    df = spark.createDataFrame(
        [
            (1, 2, LATE, EARLY),   # type 2, voucher earlier: voucher
            (2, 2, EARLY, LATE),   # type 2, voucher later: campaign
            (3, 2, LATE, LATE),    # equal
            (4, 1, LATE, EARLY),   # other type: campaign
            (5, 2, LATE, None),    # no voucher expiry: campaign
            (6, 2, None, EARLY),   # no campaign date: none
            (7, None, LATE, EARLY),
        ],
        RULE,
    )
    df = df.withColumn(
        "e", rules.actual_expire(F.col("kind"), F.col("expire_date"), F.col("voucher"))
    )
    assert column(df, "e", "i") == [EARLY, EARLY, LATE, LATE, LATE, None, LATE]


def test_voucher_expiry_past_2038(spark):
    df = spark.createDataFrame([(2147483647, 86400), (1, None), (None, 1)], "t int, v int")
    got = [r[0] for r in df.select(rules.voucher_expire(F.col("t"), F.col("v"))).collect()]
    assert got == [ts("2038-01-20 03:14:07"), None, None]


def test_expired_is_strictly_after_midnight(spark):
    df = spark.createDataFrame(
        [(1, ts("2021-05-31 23:59:59")), (2, ts("2021-06-01 00:00:00")), (3, None)],
        "i int, e timestamp",
    )
    df = df.withColumn("x", rules.is_expired(F.col("e"), dt.date(2021, 6, 1)))
    assert column(df, "x", "i") == [True, False, None]


def raw_transactions(spark, *items):
    return spark.createDataFrame(list(items), TRANSACTIONS.raw_schema)


def test_clean_transactions_keeps_success_only(spark):
    raw = raw_transactions(
        spark,
        ("a", " 1", "7", "2021-11-01 10:20:30.987", "3", "3", "100", "2"),
        ("b", "0", "7", "2021-11-01 10:20:31", "3", "3", "100", "2"),
        ("c", "1.0", "7", "2021-11-01 10:20:32", "3", "3", "100", "2"),
        ("d", None, "7", "2021-11-01 10:20:33", "3", "3", "100", "2"),
    )
    got = clean_transactions(typed(raw, TRANSACTIONS))
    assert rows(got) == [
        ("a", 1, "7", ts("2021-11-01 10:20:30"), 3, 3, 100, 2),
        ("c", 1, "7", ts("2021-11-01 10:20:32"), 3, 3, 100, 2),
    ]


def test_parse_losses_counts_only_unreadable_text(spark):
    raw = raw_transactions(
        spark,
        ("a", "1", "u7", "bad", None, "3", "100", "2"),
        ("b", "OK", "7", "also bad", "3", "3", "9999999999", "2"),
    )
    lost = dict(rows(parse_losses(raw, TRANSACTIONS)))
    assert lost == {
        "trans_status": 1, "txn_time": 2, "app_id": 0,
        "trans_type": 0, "amount": 0, "pmc_id": 0,
    }


def test_typed_users(spark):
    raw = spark.createDataFrame(
        [("5", "1990-01-02", "2", "1", "2021-11-01 10:20:30.123")], USERS.raw_schema
    )
    assert rows(typed(raw, USERS)) == [
        ("5", dt.date(1990, 1, 2), 2, 1, ts("2021-11-01 10:20:30.123"))
    ]
