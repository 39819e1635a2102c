"""Tables derived from transactions: payments, activity, apps and payment sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pursefold.operators.keyed import (
    first_last_by_key,
    keep_last_ties,
    seed_first_last,
    split_null_keys,
)
from pursefold.operators.merge import (
    merge_first_last,
    merge_first_last_ties,
    merge_pairs,
    new_pairs,
    unseen,
)
from pursefold.schemas import PAYMENT_TYPE

PAYMENT_SPAN = {
    "first": "first_payment_time",
    "last": "last_payment_time",
    "last_attr": "last_payment_app",
}
ACTIVE_SPAN = {
    "first": "first_active_time",
    "last": "last_active_time",
    "last_attr": "last_trans_type",
}
TIEBREAK = "trans_id"
PAYMENT_ID, ACTIVE_ID = "last_payment_id", "last_active_id"


def payments(txn: DataFrame) -> DataFrame:
    return txn.filter(F.col("trans_type") == PAYMENT_TYPE)


def _spans(
    txn: DataFrame, attr: str, names: dict[str, str], ties: str, tiebreak: str | None, last_id: str
) -> DataFrame:
    if ties == "one":
        return first_last_by_key(
            txn, "user_id", "txn_time", attr, tiebreak=tiebreak, last_id=last_id, **names
        )
    if ties == "all":
        events = seed_first_last(txn, "user_id", "txn_time", attr, **names)
        return keep_last_ties(events, "user_id", names["first"], names["last"])
    raise ValueError(f"ties must be 'one' or 'all', not {ties!r}")


def _merge_spans(
    state: DataFrame, txn: DataFrame, attr: str, names: dict[str, str], mode: str, ties: str,
    last_id: str,
) -> DataFrame:
    if ties == "all":
        if mode != "fold":
            raise ValueError("tied rows are kept by mode='fold' only")
        events = seed_first_last(txn, "user_id", "txn_time", attr, **names)
        return merge_first_last_ties(state, events, "user_id", names["first"], names["last"])
    batch = _spans(txn, attr, names, ties, TIEBREAK, last_id)
    return merge_first_last(state, batch, "user_id", mode=mode, last_id=last_id, **names)


def first_last_payment(
    txn: DataFrame, ties: str = "one", tiebreak: str | None = TIEBREAK
) -> DataFrame:
    """Per user: first and last payment time and the app of the last payment.

    ``txn`` holds successful transactions. Payments at the same last time are
    decided by the last transaction id (``id_order``), or all kept with ``ties='all'``.
    """
    return _spans(payments(txn), "app_id", PAYMENT_SPAN, ties, tiebreak, PAYMENT_ID)


def payment_update(
    state: DataFrame, txn: DataFrame, mode: str = "fold", ties: str = "one"
) -> DataFrame:
    return _merge_spans(state, payments(txn), "app_id", PAYMENT_SPAN, mode, ties, PAYMENT_ID)


def first_last_activity(
    txn: DataFrame, ties: str = "one", tiebreak: str | None = TIEBREAK
) -> DataFrame:
    """Per user: first and last transaction time and the type of the last one."""
    return _spans(txn, "trans_type", ACTIVE_SPAN, ties, tiebreak, ACTIVE_ID)


def activity_update(
    state: DataFrame, txn: DataFrame, mode: str = "fold", ties: str = "one"
) -> DataFrame:
    return _merge_spans(state, txn, "trans_type", ACTIVE_SPAN, mode, ties, ACTIVE_ID)


def _pairs(txn: DataFrame, other: str) -> DataFrame:
    full, _ = split_null_keys(txn.select("user_id", other), ["user_id", other])
    return full.distinct()


def user_apps(txn: DataFrame) -> DataFrame:
    """Distinct (user, app)."""
    return _pairs(txn, "app_id")


def user_apps_update(state: DataFrame, txn: DataFrame) -> DataFrame:
    return merge_pairs(state, user_apps(txn))


def user_apps_new(state: DataFrame, txn: DataFrame) -> DataFrame:
    return new_pairs(state, user_apps(txn), ["user_id", "app_id"])


def user_apps_insert(state: DataFrame, txn: DataFrame) -> DataFrame:
    """``user_apps_new`` for a stored state."""
    return unseen(state, user_apps(txn), ["user_id", "app_id"])


def user_payment_sources(txn: DataFrame) -> DataFrame:
    """Distinct (user, payment channel)."""
    return _pairs(txn, "pmc_id")


def user_payment_sources_update(state: DataFrame, txn: DataFrame) -> DataFrame:
    return merge_pairs(state, user_payment_sources(txn))


def user_payment_sources_new(state: DataFrame, txn: DataFrame) -> DataFrame:
    return new_pairs(state, user_payment_sources(txn), ["user_id", "pmc_id"])


def user_payment_sources_insert(state: DataFrame, txn: DataFrame) -> DataFrame:
    """``user_payment_sources_new`` for a stored state."""
    return unseen(state, user_payment_sources(txn), ["user_id", "pmc_id"])
