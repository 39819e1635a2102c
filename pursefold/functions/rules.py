"""Date rules: age and promotion expiry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from pursefold.schemas import EARLIER_EXPIRY_CAMPAIGN

DAYS_PER_YEAR = 365.25


def as_date(as_of: dt.date | str | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def age_years(birthdate: Column, as_of: dt.date | str | Column) -> Column:
    """Whole years of 365.25 days, so a birthday may count one day late."""
    return F.floor(F.datediff(as_date(as_of), birthdate) / F.lit(DAYS_PER_YEAR)).cast("int")


def voucher_expire(time_s: Column, valid_secs: Column) -> Column:
    """Claim time plus validity, in 64-bit seconds."""
    return (time_s.cast("bigint") + valid_secs.cast("bigint")).cast("timestamp")


def actual_expire(campaign_type: Column, expire_date: Column, voucher_expiry: Column) -> Column:
    """Earlier of the two dates for the earlier-expiry campaign type, else the campaign date.

    A NULL on either side of the comparison falls to the campaign date.
    """
    takes_voucher = (campaign_type == EARLIER_EXPIRY_CAMPAIGN) & (expire_date > voucher_expiry)
    return F.when(takes_voucher, voucher_expiry).otherwise(expire_date)


def is_expired(expiry: Column, as_of: dt.date | str | Column) -> Column:
    """True once midnight of ``as_of`` is past the expiry; NULL without an expiry."""
    return as_date(as_of).cast("timestamp") > expiry
