"""Registered queries: (spark, sf_dir) -> DataFrame over the benchmark tables.

Times and dates leave as zone-free timestamps, the form the tables' own times have.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pursefold import bindings as b
from pursefold.functions.parsing import to_second
from pursefold.operators import audit
from pursefold.operators.cleaning import clean_transactions
from pursefold.operators.keyed import keep_last_ties, seed_first_last, split_null_keys
from pursefold.operators.merge import merge_first_last_ties
from pursefold.plans import activity, daily, profile, promotion
from pursefold.schemas import (
    ACTIVE,
    PAYMENT,
    PAYMENT_TYPE,
    PROMOTIONS,
    SUCCESS_STATUS,
    TRANSACTIONS,
    USER_APP,
    USER_INFO,
    USER_PMC,
    USER_PROMOTION,
    USERS,
    VOUCHER,
)
from pursefold.sources import lake
from pursefold.sources.paths import shared_folder
from pursefold.sources.state import StateStore
from pursefold.sources.tsv import day_path, folders, read_entity, read_raw, typed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _zone_free(df: DataFrame) -> DataFrame:
    times = [name for name, kind in df.dtypes if kind in ("timestamp", "date")]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # The ids by which stored spans settle ties are the tables' own business.
        return _zone_free(build(spark, sf_dir).drop("last_payment_id", "last_active_id"))

    QUERIES[build.__name__] = run
    return run


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_transactions(b.transactions(spark, sf_dir))


def _clean_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return b.base_and_update(_clean(spark, sf_dir))


# Profiles


@query
def latest_profile(spark, sf_dir):
    return profile.latest_profile(b.users(spark, sf_dir), tiebreak=["event_id"])


@query
def profile_merge_newer(spark, sf_dir):
    base, update = b.base_and_update(b.users(spark, sf_dir))
    state = profile.latest_profile(base, tiebreak=["event_id"])
    return profile.profile_update(state, update, tiebreak=["event_id"])


@query
def profile_merge_union(spark, sf_dir):
    base, update = b.base_and_update(b.users(spark, sf_dir))
    state = profile.latest_profile(base, tiebreak=["event_id"])
    batch = profile.latest_profile(update, tiebreak=["event_id"])
    return profile.with_age(profile.profile_merge_union(state, batch), b.AGE_AS_OF)


@query
def age_histogram(spark, sf_dir):
    aged = profile.with_age(b.users(spark, sf_dir), b.AGE_AS_OF)
    return aged.groupBy("user_id", "age").agg(F.count(F.lit(1)).alias("n"))


# Transactions


@query
def transaction_status_counts(spark, sf_dir):
    txn = b.transactions(spark, sf_dir)
    return txn.groupBy("trans_status").agg(F.count(F.lit(1)).alias("n"))


@query
def successful_transactions(spark, sf_dir):
    return _clean(spark, sf_dir).drop("is_new")


@query
def transactions_from_text(spark, sf_dir):
    raw = b.transactions_as_text(spark, sf_dir)
    return clean_transactions(typed(raw, TRANSACTIONS))


@query
def text_parse_losses(spark, sf_dir):
    return audit.parse_losses(b.transactions_as_text(spark, sf_dir), TRANSACTIONS)


@query
def rejected_transactions(spark, sf_dir):
    """Transactions whose user id cannot be read."""
    txn = typed(b.transactions_as_text(spark, sf_dir), TRANSACTIONS)
    _, rejected = split_null_keys(txn, TRANSACTIONS.key)
    return rejected.select("trans_id", "trans_type", "amount")


@query
def first_last_payment(spark, sf_dir):
    return activity.first_last_payment(_clean(spark, sf_dir))


@query
def first_last_activity(spark, sf_dir):
    return activity.first_last_activity(_clean(spark, sf_dir))


@query
def first_last_order_one(spark, sf_dir):
    """One row per customer where last dates tie: the largest order key decides."""
    return activity.first_last_activity(b.orders_as_transactions(spark, sf_dir))


@query
def argmax_keep_ties(spark, sf_dir):
    events = seed_first_last(
        b.orders_as_transactions(spark, sf_dir),
        "user_id", "txn_time", "o_orderpriority",
        first="first_time", last="last_time", last_attr="last_priority",
    )
    return keep_last_ties(events, "user_id", "first_time", "last_time")


@query
def payment_merge_fold(spark, sf_dir):
    base, update = _clean_split(spark, sf_dir)
    return activity.payment_update(activity.first_last_payment(base), update, mode="fold")


@query
def payment_merge_either(spark, sf_dir):
    base, update = _clean_split(spark, sf_dir)
    return activity.payment_update(activity.first_last_payment(base), update, mode="either")


@query
def payment_fold_keep_ties(spark, sf_dir):
    span = activity.PAYMENT_SPAN
    txn = clean_transactions(b.orders_as_transactions(spark, sf_dir))
    base, update = [
        seed_first_last(part, "user_id", "txn_time", "app_id", **span)
        for part in b.base_and_update(txn)
    ]
    state = keep_last_ties(base, "user_id", span["first"], span["last"])
    return merge_first_last_ties(state, update, "user_id", span["first"], span["last"])


@query
def payment_fold_cross_batch_ties(spark, sf_dir):
    """Payments of one day in the base and in the update: the largest order key decides."""
    base, update = b.base_and_update(clean_transactions(b.orders_as_transactions(spark, sf_dir)))
    return activity.payment_update(activity.first_last_payment(base), update)


@query
def activity_fold_keep_ties(spark, sf_dir):
    txn = clean_transactions(b.orders_as_transactions(spark, sf_dir))
    base, update = b.base_and_update(txn)
    state = activity.first_last_activity(base, ties="all")
    return activity.activity_update(state, update, ties="all")


@query
def activity_merge_fold(spark, sf_dir):
    base, update = _clean_split(spark, sf_dir)
    return activity.activity_update(activity.first_last_activity(base), update, mode="fold")


@query
def activity_merge_either(spark, sf_dir):
    base, update = _clean_split(spark, sf_dir)
    return activity.activity_update(activity.first_last_activity(base), update, mode="either")


@query
def user_apps(spark, sf_dir):
    return activity.user_apps(_clean(spark, sf_dir))


@query
def user_apps_merge(spark, sf_dir):
    base, update = _clean_split(spark, sf_dir)
    return activity.user_apps_update(activity.user_apps(base), update)


@query
def user_apps_new(spark, sf_dir):
    base, update = _clean_split(spark, sf_dir)
    return activity.user_apps_new(activity.user_apps(base), update)


@query
def user_payment_sources(spark, sf_dir):
    return activity.user_payment_sources(_clean(spark, sf_dir))


@query
def user_payment_sources_merge(spark, sf_dir):
    base, update = _clean_split(spark, sf_dir)
    return activity.user_payment_sources_update(activity.user_payment_sources(base), update)


@query
def user_payment_sources_new(spark, sf_dir):
    base, update = _clean_split(spark, sf_dir)
    return activity.user_payment_sources_new(activity.user_payment_sources(base), update)


# Promotions

CLAIM_COLUMNS = ["user_id", "voucher_code", "campaign_id", "status", "time_s"]


def _promotions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return b.promotions(spark, sf_dir).drop("is_new"), b.campaigns(spark, sf_dir)


@query
def promotion_with_campaign(spark, sf_dir):
    joined = promotion.promotion_with_campaign(*_promotions(spark, sf_dir))
    return joined.select(*CLAIM_COLUMNS, "campaign_type", "expire_date", "voucher_expire")


@query
def promotion_expiry(spark, sf_dir):
    joined = promotion.promotion_with_campaign(*_promotions(spark, sf_dir))
    return promotion.actual_expiry(joined).select(*CLAIM_COLUMNS, "voucher_expire", "actual_expire")


@query
def promotion_expiry_voucher_min(spark, sf_dir):
    joined = promotion.promotion_with_campaign(*_promotions(spark, sf_dir))
    claims = promotion.actual_expiry(promotion.voucher_expiry_min(joined))
    return claims.select(*CLAIM_COLUMNS, "voucher_expire", "actual_expire")


@query
def promotion_expiry_null_vouchers(spark, sf_dir):
    """As above where every seventh claim has no voucher code: it keeps its own expiry."""
    promotions, campaigns = _promotions(spark, sf_dir)
    code = F.when(F.col("user_id") % 7 != 0, F.col("voucher_code"))
    joined = promotion.promotion_with_campaign(promotions.withColumn("voucher_code", code), campaigns)
    claims = promotion.actual_expiry(promotion.voucher_expiry_min(joined))
    return claims.select(*CLAIM_COLUMNS, "voucher_expire", "actual_expire")


@query
def promotion_status(spark, sf_dir):
    return promotion.promotion_status(*_promotions(spark, sf_dir), b.PROMOTION_AS_OF)


@query
def promotion_merge_overwrite(spark, sf_dir):
    base, update = b.base_and_update(b.promotions(spark, sf_dir))
    campaigns = b.campaigns(spark, sf_dir)
    state = promotion.latest_promotion(base, campaigns, b.PROMOTION_AS_OF)
    return promotion.promotion_update(state, update, campaigns, b.PROMOTION_AS_OF)


@query
def voucher_update(spark, sf_dir):
    base, update = b.base_and_update(b.promotions(spark, sf_dir))
    return promotion.voucher_update(base, update, b.campaigns(spark, sf_dir))


# Audits


@query
def arrivals(spark, sf_dir):
    observed = {
        "orders": b.store_dates(spark, sf_dir, "orders", "o_orderdate"),
        "shipments": b.store_dates(spark, sf_dir, "lineitem", "l_shipdate"),
        "events": b.store_dates(spark, sf_dir, "events", "ts"),
    }
    return audit.arrivals(spark, observed, b.ARRIVALS_FROM, b.ARRIVALS_TO)


@query
def stage_counts(spark, sf_dir):
    successful = F.col("trans_status") == SUCCESS_STATUS
    stages = {
        "transactions": F.lit(True),
        "successful": successful,
        "payments": successful & (F.col("trans_type") == PAYMENT_TYPE),
    }
    return audit.stage_counts_of(b.transactions(spark, sf_dir), stages)


# Sources, lake, snapshots and the daily run


@query
def daily_run(spark, sf_dir):
    """All six tables after two daily runs over source files, summed up per user."""
    folder = shared_folder(spark)
    source, state = f"{folder}/source", StateStore(spark, f"{folder}/state")
    b.write_source_days(spark, sf_dir, source)
    for day in b.SOURCE_DAYS:
        daily.run_day(spark, source, f"{folder}/lake", state, day, as_of=b.PROMOTION_AS_OF)
    count = F.count(F.lit(1))
    apps = state.read(USER_APP).groupBy("user_id").agg(count.alias("n_apps"))
    sources = state.read(USER_PMC).groupBy("user_id").agg(count.alias("n_sources"))
    promotions = state.read(USER_PROMOTION).groupBy("user_id").agg(
        count.alias("n_promotions"), F.count_if("expired").alias("n_expired")
    )
    per_user = state.read(USER_INFO)
    for part in (state.read(PAYMENT), state.read(ACTIVE), apps, sources, promotions):
        per_user = per_user.join(part, "user_id", "full")
    per_user = per_user.withColumn("user_id", F.col("user_id").cast("bigint"))
    return per_user.fillna(0, ["n_apps", "n_sources", "n_promotions", "n_expired"])


@query
def profiles_text_ids(spark, sf_dir):
    """Profiles of users whose ids are no numbers, or differ by leading zeros only, after a daily run."""
    folder = shared_folder(spark)
    state = StateStore(spark, f"{folder}/state")
    users = b.users(spark, sf_dir)
    b.write_source_day(users.withColumn("user_id", b.text_id()), USERS, f"{folder}/source", b.SOURCE_DAYS[0])
    daily.run_day(spark, f"{folder}/source", f"{folder}/lake", state, b.SOURCE_DAYS[0])
    return state.read(USER_INFO)


@query
def raw_lake_text(spark, sf_dir):
    """Cells of a lake day as text, counted by their text: what was written is what is kept."""
    folder = shared_folder(spark)
    text = b.users(spark, sf_dir).withColumn("user_id", b.text_id())
    b.write_source_day(text, USERS, f"{folder}/source", b.SOURCE_DAYS[0])
    raw = read_raw(spark, day_path(f"{folder}/source", USERS, b.SOURCE_DAYS[0]), USERS)
    lake.write_raw_day(raw, f"{folder}/lake", USERS, b.SOURCE_DAYS[0])
    stored = spark.read.parquet(lake.lake_path(f"{folder}/lake", USERS))
    return stored.groupBy(F.col("userid").alias("user_id"), F.col("birthdate").alias("birthdate_text")).agg(F.count(F.lit(1)).alias("n"))


@query
def lake_by_folder(spark, sf_dir):
    """Claims read from a lake of day folders whose columns are text, with times as text."""
    folder = shared_folder(spark)
    for day, part in zip(b.SOURCE_DAYS, b.base_and_update(b.promotions(spark, sf_dir))):
        b.as_text(part, PROMOTIONS).write.parquet(f"{folder}/promotions/{day}")
    return lake.read_foreign_lake(spark, folder, PROMOTIONS)


@query
def lake_mixed_types(spark, sf_dir):
    """Claims of a lake in another folder, of which one day is stored as text and one typed."""
    folder = shared_folder(spark)
    base, update = b.base_and_update(b.promotions(spark, sf_dir))
    b.as_text(base, PROMOTIONS).write.parquet(f"{folder}/promotion/{b.SOURCE_DAYS[0]}")
    b.typed_like_files(update, PROMOTIONS).write.parquet(f"{folder}/promotion/{b.SOURCE_DAYS[1]}")
    return lake.read_foreign_lake(spark, folder, PROMOTIONS, "promotion")


@query
def lake_typed_users(spark, sf_dir):
    """Profiles of a lake in another folder, of which one day is stored typed and one as text."""
    folder = shared_folder(spark)
    base, update = b.base_and_update(b.users(spark, sf_dir))
    b.typed_like_files(base, USERS).write.parquet(f"{folder}/user/{b.SOURCE_DAYS[0]}")
    b.as_text(update, USERS).write.parquet(f"{folder}/user/{b.SOURCE_DAYS[1]}")
    users = lake.read_foreign_lake(spark, folder, USERS, "user")
    return users.withColumn("updated_time", to_second(F.col("updated_time")))


@query
def surplus_cells(spark, sf_dir):
    """Parse losses of a source day in which some lines have a cell too many or too few."""
    folder = shared_folder(spark)
    b.write_uneven_lines(b.transactions_as_text(spark, sf_dir), TRANSACTIONS, folder, b.SOURCE_DAYS[0])
    raw = read_raw(spark, day_path(folder, TRANSACTIONS, b.SOURCE_DAYS[0]), TRANSACTIONS, malformed=True)
    return audit.parse_losses(raw, TRANSACTIONS)


@query
def malformed_lines(spark, sf_dir):
    """Lines with a cell too many or too few, as they are kept beside the lake, by their number of cells."""
    folder = shared_folder(spark)
    b.write_uneven_lines(b.transactions_as_text(spark, sf_dir), TRANSACTIONS, folder, b.SOURCE_DAYS[0])
    lake.backfill(spark, folder, f"{folder}/lake", TRANSACTIONS)
    lines = lake.read_malformed(spark, f"{folder}/lake", TRANSACTIONS)
    cells = F.size(F.split("line", "\t")).alias("n_cells")
    return lines.groupBy("store_date", cells).agg(F.count(F.lit(1)).alias("n"))


@query
def backfill_folders(spark, sf_dir):
    """Folders found by a backfill, one of them named like no day, with the rows that reached the lake."""
    folder = shared_folder(spark)
    for day, part in zip((b.SOURCE_DAYS[0], "20240202"), b.base_and_update(b.users(spark, sf_dir))):
        b.write_source_day(part, USERS, f"{folder}/source", day)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", UserWarning)
        found = lake.backfill(spark, f"{folder}/source", f"{folder}/lake", USERS)
    stored = lake.read_lake(spark, f"{folder}/lake", USERS).groupBy("store_date").agg(F.count(F.lit(1)).alias("n_rows"))
    return found.join(stored, "store_date", "left").select("folder", "store_date", "read", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


@query
def arrivals_listed(spark, sf_dir):
    """Which entities have files for a day, from the listing of the source folders."""
    folder = shared_folder(spark)
    base, update = b.base_and_update(b.promotions(spark, sf_dir))
    b.write_source_day(base, PROMOTIONS, folder, b.SOURCE_DAYS[0])
    b.write_source_day(update, PROMOTIONS, folder, b.SOURCE_DAYS[1])
    b.write_source_day(b.base_and_update(b.users(spark, sf_dir))[1], USERS, folder, b.SOURCE_DAYS[1])
    found = {e.folder: folders(spark, folder, e.folder) for e in (USERS, TRANSACTIONS, PROMOTIONS)}
    return audit.arrivals_listed(spark, found, "2024-01-31", "2024-02-03").drop("n_files", "bytes")


@query
def daily_report(spark, sf_dir):
    """The report of a day of users and transactions."""
    folder = shared_folder(spark)
    for entity, bound in ((USERS, b.users(spark, sf_dir)), (TRANSACTIONS, b.transactions(spark, sf_dir))):
        b.write_source_day(b.base_and_update(bound)[0], entity, f"{folder}/source", b.SOURCE_DAYS[0])
    return daily.run_day(spark, f"{folder}/source", f"{folder}/lake", StateStore(spark, f"{folder}/state"), b.SOURCE_DAYS[0])


@query
def daily_either_rerun(spark, sf_dir):
    """Payments after two daily runs that move one end a run, each of them repeated."""
    folder = shared_folder(spark)
    state = StateStore(spark, f"{folder}/state")
    for day, part in zip(b.SOURCE_DAYS, b.base_and_update(b.transactions(spark, sf_dir))):
        b.write_source_day(part, TRANSACTIONS, f"{folder}/source", day)
        for _ in range(2):
            daily.run_day(spark, f"{folder}/source", f"{folder}/lake", state, day, mode="either")
    return state.read(PAYMENT).withColumn("user_id", F.col("user_id").cast("bigint"))


@query
def voucher_daily(spark, sf_dir):
    """Vouchers after two daily runs."""
    folder = shared_folder(spark)
    state = StateStore(spark, f"{folder}/state")
    bound = b.promotions(spark, sf_dir)
    for day, part in zip(b.SOURCE_DAYS, b.base_and_update(bound)):
        b.write_source_day(part, PROMOTIONS, f"{folder}/source", day)
    b.write_campaigns(b.campaigns(spark, sf_dir), f"{folder}/source")
    for day in b.SOURCE_DAYS:
        daily.run_day(spark, f"{folder}/source", f"{folder}/lake", state, day, as_of=b.PROMOTION_AS_OF)
    return state.read(VOUCHER).withColumn("user_id", F.col("user_id").cast("bigint"))


@query
def history_load(spark, sf_dir):
    """Five tables published once from a lake of all days, summed up per user."""
    folder = shared_folder(spark)
    source, lake_root, state = f"{folder}/source", f"{folder}/lake", StateStore(spark, f"{folder}/state")
    for entity, bound in ((USERS, b.users(spark, sf_dir)), (TRANSACTIONS, b.transactions(spark, sf_dir))):
        for day, part in zip(b.SOURCE_DAYS, b.base_and_update(bound)):
            b.write_source_day(part, entity, source, day)
        lake.backfill(spark, source, lake_root, entity)
    daily.load_history(spark, lake_root, state)
    count = F.count(F.lit(1))
    apps = state.read(USER_APP).groupBy("user_id").agg(count.alias("n_apps"))
    sources = state.read(USER_PMC).groupBy("user_id").agg(count.alias("n_sources"))
    per_user = state.read(USER_INFO)
    for part in (state.read(PAYMENT), state.read(ACTIVE), apps, sources):
        per_user = per_user.join(part, "user_id", "full")
    return per_user.withColumn("user_id", F.col("user_id").cast("bigint")).fillna(0, ["n_apps", "n_sources"])


@query
def backfilled_lake_days(spark, sf_dir):
    """Totals per lake day after loading all source days at once, then one day again."""
    folder = shared_folder(spark)
    source, lake_root = f"{folder}/source", f"{folder}/lake"
    for day, part in zip(b.SOURCE_DAYS, b.base_and_update(b.transactions(spark, sf_dir))):
        b.write_source_day(part, TRANSACTIONS, source, day)
    lake.backfill(spark, source, lake_root, TRANSACTIONS)
    day = b.SOURCE_DAYS[0]
    again = read_entity(spark, source, TRANSACTIONS, day)
    lake.write_clean_day(again, lake_root, day)
    days = lake.read_lake(spark, lake_root, TRANSACTIONS)
    return days.groupBy("store_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("amount").alias("amount"),
        F.count_if(F.col("trans_type") == PAYMENT_TYPE).alias("n_payments"),
    )
