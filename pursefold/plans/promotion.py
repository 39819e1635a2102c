"""Promotion status and voucher expiry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pursefold.functions.rules import actual_expire, is_expired, voucher_expire
from pursefold.operators.keyed import latest_by_key, with_group_min
from pursefold.operators.merge import merge_into_vouchers, merge_overwrite
from pursefold.schemas import EARLIER_EXPIRY_CAMPAIGN, USER_PROMOTION, VOUCHER


def promotion_with_campaign(
    promotions: DataFrame, campaigns: DataFrame, unknown: Observation | None = None
) -> DataFrame:
    """Promotions with their campaign and ``voucher_expire`` = claim time + validity.

    ``campaigns`` has one row per id; promotions of unknown campaigns drop out, and ``unknown``
    counts them (``n``) while the result is computed. Spark broadcasts the campaigns if they are
    small in bytes and splits hot ones if not.
    """
    if unknown is None:
        joined = promotions.join(campaigns, "campaign_id")
    else:
        known = campaigns.withColumn("known", F.lit(True))
        joined = promotions.join(known, "campaign_id", "left")
        joined = joined.observe(unknown, F.count_if(F.col("known").isNull()).alias("n"))
        joined = joined.filter("known").drop("known")
    return joined.withColumn(
        "voucher_expire", voucher_expire(F.col("time_s"), F.col("expire_secs"))
    )


def voucher_expiry_min(claims: DataFrame) -> DataFrame:
    """Give every claim the earliest ``voucher_expire`` of its voucher code, if it has one."""
    return with_group_min(claims, "voucher_code", "voucher_expire")


def actual_expiry(claims: DataFrame) -> DataFrame:
    """Add ``actual_expire`` to promotions joined with their campaigns."""
    return claims.withColumn(
        "actual_expire",
        actual_expire(F.col("campaign_type"), F.col("expire_date"), F.col("voucher_expire")),
    )


def _dated_status(
    promotions: DataFrame, campaigns: DataFrame, as_of: dt.date | str
) -> DataFrame:
    claims = actual_expiry(promotion_with_campaign(promotions, campaigns))
    return claims.withColumn("expired", is_expired(F.col("actual_expire"), as_of))


def promotion_status(
    promotions: DataFrame, campaigns: DataFrame, as_of: dt.date | str
) -> DataFrame:
    """Distinct (user, campaign, status, expired)."""
    dated = _dated_status(promotions, campaigns, as_of)
    return dated.select(*USER_PROMOTION.names).distinct()


def latest_of_claims(claims: DataFrame, as_of: dt.date | str) -> DataFrame:
    """One status per (user, campaign) of ``voucher_claims``: that of the latest one, then largest voucher code."""
    dated = claims.withColumn("expired", is_expired(F.col("actual_expire"), as_of)).filter(F.col("user_id").isNotNull())
    columns = USER_PROMOTION.names
    rows = dated.select(*columns, "time_s", "voucher_code")
    return latest_by_key(rows, USER_PROMOTION.key, ["time_s", "voucher_code"]).select(*columns)


def latest_promotion(
    promotions: DataFrame, campaigns: DataFrame, as_of: dt.date | str
) -> DataFrame:
    """One status per (user, campaign): that of the latest claim, then largest voucher code."""
    return latest_of_claims(voucher_claims(promotions, campaigns), as_of)


def promotion_update(
    state: DataFrame, promotions: DataFrame, campaigns: DataFrame, as_of: dt.date | str
) -> DataFrame:
    """Merge a batch of promotions; its (user, campaign) rows replace the stored ones."""
    return claims_update(state, voucher_claims(promotions, campaigns), as_of)


def claims_update(state: DataFrame, claims: DataFrame, as_of: dt.date | str) -> DataFrame:
    """``promotion_update`` by a batch of ``voucher_claims``."""
    return merge_overwrite(state, latest_of_claims(claims, as_of), USER_PROMOTION.key)


def voucher_claims(
    promotions: DataFrame, campaigns: DataFrame, min_per_voucher: bool = False,
    unknown: Observation | None = None,
) -> DataFrame:
    """Claims with their actual expiry; optionally from the voucher's earliest expiry."""
    claims = promotion_with_campaign(promotions, campaigns, unknown)
    if min_per_voucher:
        claims = voucher_expiry_min(claims)
    return actual_expiry(claims).select(*VOUCHER.names)


def voucher_merge(state: DataFrame, promotions: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Merge a batch of promotions into stored vouchers, which have one row each."""
    return merge_into_vouchers(state, voucher_claims(promotions, campaigns))


def voucher_update(base: DataFrame, update: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Latest claim and earliest actual expiry per voucher over a base load and an update.

    In the base the campaign rule sees the voucher's earliest ``voucher_expire``;
    in the update each claim's own. Equal to ``merge_vouchers`` of the two
    ``voucher_claims``, but in one aggregation: under the rule, the earliest
    actual expiry of a voucher's base rows is the least of its earliest campaign
    date and, if an earlier-expiry campaign with a date is among them, its
    earliest ``voucher_expire``.
    """
    rows = base.withColumn("in_base", F.lit(True)).unionByName(
        update.withColumn("in_base", F.lit(False))
    )
    rows = actual_expiry(promotion_with_campaign(rows, campaigns)).filter(
        F.col("voucher_code").isNotNull()
    )
    in_base = F.col("in_base")
    takes_earlier = F.col("campaign_type") == EARLIER_EXPIRY_CAMPAIGN
    claim = F.struct("time_s", "campaign_id", "user_id", "status")
    merged = rows.groupBy("voucher_code").agg(
        F.max(claim).alias("claim"),
        F.min(F.when(in_base, F.col("expire_date"))).alias("base_campaign"),
        F.min(F.when(in_base, F.col("voucher_expire"))).alias("base_voucher"),
        F.bool_or(in_base & takes_earlier & F.col("expire_date").isNotNull()).alias("base_earlier"),
        F.min(F.when(~in_base, F.col("actual_expire"))).alias("update_expire"),
    )
    base_voucher = F.when(F.col("base_earlier"), F.col("base_voucher"))
    expire = F.least("base_campaign", base_voucher, "update_expire").alias("actual_expire")
    return merged.select(
        "voucher_code",
        *[F.col("claim")[c].alias(c) for c in ("user_id", "campaign_id", "status", "time_s")],
        expire,
    )
