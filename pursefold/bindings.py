"""The entities as views over the benchmark tables.

``is_new`` divides a table into a base load and an update; queries that merge
use both parts, so every row takes part. The split of ``events`` is by user and
event so that each merge rule meets users it applies to: users only in the base,
only in the update, and in both with either end wider.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pursefold.schemas import CAMPAIGNS, PROMOTIONS, TRANSACTIONS, USERS, Entity
from pursefold.sources.tsv import day_path

# Transaction types of the bound event types; anything else is type 5.
EVENT_TRANS_TYPES = {"click": 1, "view": 2, "purchase": 3, "signup": 4}
OTHER_TRANS_TYPE = 5

ARRIVALS_FROM, ARRIVALS_TO = "2001-07-25", "2001-08-07"
AGE_AS_OF = "2024-02-01"
PROMOTION_AS_OF = "1998-06-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _prop_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _event_is_new() -> Column:
    slot = F.col("user_id") % 10
    return (slot == 5) | ((slot != 0) & (F.col("event_id") % 2 == 0))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From events."""
    event = F.col("event_type")
    trans_type = F.lit(OTHER_TRANS_TYPE)
    for name, code in EVENT_TRANS_TYPES.items():
        trans_type = F.when(event == name, code).otherwise(trans_type)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("trans_id"),
        F.when(event == "error", 0).otherwise(1).alias("trans_status"),
        "user_id",
        F.col("ts").cast("timestamp").alias("txn_time"),
        (_prop_k() % 10).alias("app_id"),
        trans_type.alias("trans_type"),
        F.col("value").cast("bigint").alias("amount"),
        (_prop_k() % 7).alias("pmc_id"),
        _event_is_new().alias("is_new"),
    )


def orders_as_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From orders, whose dates tie within a customer."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("trans_id"),
        F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("trans_status"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("timestamp").alias("txn_time"),
        (F.col("o_orderkey") % 25).cast("int").alias("app_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("trans_type"),
        "o_orderpriority",
        (F.col("o_orderkey") % 3 == 0).alias("is_new"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From events; ``event_id`` is kept to order profiles of the same second."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.date_add(F.lit("1960-01-01").cast("date"), 150 * _prop_k()).alias("birthdate"),
        (_prop_k() % 4).alias("profile_level"),
        (_prop_k() % 2).alias("gender"),
        F.col("ts").cast("timestamp").alias("updated_time"),
        "event_id",
        _event_is_new().alias("is_new"),
    )


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From part."""
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("campaign_id"),
        (1 + size % 2).cast("int").alias("campaign_type"),
        F.date_add(F.lit("1996-01-01").cast("date"), 40 * size)
        .cast("timestamp")
        .alias("expire_date"),
        (size.cast("bigint") * 86400 * 20).alias("expire_secs"),
    )


def promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From lineitem."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("user_id"),
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("voucher_code"),
        F.col("l_returnflag").alias("status"),
        F.col("l_partkey").alias("campaign_id"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("time_s"),
        (F.col("l_linestatus") == "F").alias("is_new"),
    )


def base_and_update(bound: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        bound.filter(~F.col("is_new")).drop("is_new"),
        bound.filter(F.col("is_new")).drop("is_new"),
    )


def store_dates(spark: SparkSession, sf_dir: str, name: str, column: str) -> DataFrame:
    return table(spark, sf_dir, name).select(F.to_date(column).alias("store_date"))


def transactions_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a daily file would carry them: all text, in mixed forms, some unreadable."""
    form = F.col("event_id") % 4
    spaced = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    status = F.when(F.col("event_type") == "error", "0").otherwise("1")
    trans_type = F.lit(str(OTHER_TRANS_TYPE))
    for name, code in EVENT_TRANS_TYPES.items():
        trans_type = F.when(F.col("event_type") == name, str(code)).otherwise(trans_type)
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("transid"),
        F.when(form == 0, status)
        .when(form == 1, F.concat(F.lit(" "), status))
        .when(form == 2, F.concat(F.lit("0"), status))
        .otherwise(F.concat(status, F.lit(".0")))
        .alias("transStatus"),
        F.when(F.col("event_id") % 16 == 7, F.concat(F.lit("u0"), F.col("user_id")))
        .when(F.col("event_id") % 16 != 3, F.col("user_id").cast("string"))
        .alias("userId"),
        F.when(form == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))
        .when(form == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(F.col("event_id") % 8 == 2, F.concat(F.lit("at "), spaced))
        .otherwise(spaced)
        .alias("transactionTime"),
        (k % 10).cast("string").alias("appId"),
        trans_type.alias("transType"),
        F.col("value").cast("bigint").cast("string").alias("amount"),
        (k % 7).cast("string").alias("pmcId"),
    )


# Store dates given to the base load and the update when written as daily files.
SOURCE_DAYS = ("2024-02-01", "2024-02-02")


def text_id() -> Column:
    """User ids of which some are no numbers and some have leading zeros."""
    user = F.col("user_id").cast("string")
    return F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("u"), user)).when(
        F.col("user_id") % 3 == 1, F.concat(F.lit("00"), user)
    ).otherwise(user)


def as_text(df: DataFrame, entity: Entity) -> DataFrame:
    """The entity's columns as text, under their file headers; times written out."""
    written = {
        "time": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS"),
        "epoch": lambda c: F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd HH:mm:ss"),
    }
    text = lambda c: F.col(c).cast("string")
    return df.select(*[written.get(f.kind, text)(f.name).alias(f.header) for f in entity.fields])


def write_source_day(df: DataFrame, entity: Entity, root: str, day: str) -> None:
    as_text(df, entity).write.csv(day_path(root, entity, day), sep="\t", header=True)


def write_campaigns(df: DataFrame, root: str) -> None:
    as_text(df, CAMPAIGNS).write.csv(f"{root}/{CAMPAIGNS.folder}", sep="\t", header=True)


def write_source_days(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The bound entities as two days of tab-separated source files, and the campaigns."""
    bound = {
        USERS: users(spark, sf_dir),
        TRANSACTIONS: transactions(spark, sf_dir),
        PROMOTIONS: promotions(spark, sf_dir),
    }
    for entity, df in bound.items():
        for day, part in zip(SOURCE_DAYS, base_and_update(df)):
            write_source_day(part, entity, root, day)
    write_campaigns(campaigns(spark, sf_dir), root)


def write_uneven_lines(raw: DataFrame, entity: Entity, root: str, day: str) -> None:
    """A source day in which one line in ten has a surplus cell and one in ten lacks the last cell."""
    cells = [F.coalesce(F.col(f.header), F.lit("")) for f in entity.fields]
    slot = F.col(entity.fields[0].header).cast("bigint") % 10
    line = F.when(slot == 6, F.concat_ws("\t", *cells[:-1])).otherwise(F.concat_ws("\t", *cells))
    line = F.when(slot == 3, F.concat(line, F.lit("\tmore"))).otherwise(line)
    header = "\t".join(f.header for f in entity.fields)
    raw.select(line.alias(header)).write.csv(
        day_path(root, entity, day), sep="\x01", header=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def typed_like_files(df: DataFrame, entity: Entity) -> DataFrame:
    """The entity's columns under their file headers with the types of a lake that was written typed."""
    kinds = {"int": "int", "long": "int", "date": "date", "time": "timestamp", "epoch": "int", "text": "string"}
    return df.select(*[F.col(f.name).cast(kinds[f.kind]).alias(f.header) for f in entity.fields])
