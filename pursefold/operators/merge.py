"""Merging a batch into a keyed table.

``state`` and ``batch`` hold one row per key unless said otherwise, and keys
are not NULL (see ``split_null_keys``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pursefold.operators.keyed import id_order, keep_last_ties


def _side_by_side(state: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join: keys, then ``old`` and ``new`` structs (NULL where absent)."""
    rest = [c for c in state.columns if c not in keys]
    old = state.select(*keys, F.struct(*rest).alias("old"))
    new = batch.select(*keys, F.struct(*rest).alias("new"))
    return old.join(new, list(keys), "full")


def _later(new: Column, old: Column) -> Column:
    """new > old, where a NULL old loses and a NULL new never wins."""
    return F.coalesce(new > old, old.isNull() & new.isNotNull())


def _earlier(new: Column, old: Column) -> Column:
    return F.coalesce(new < old, old.isNull() & new.isNotNull())


def merge_newer(
    state: DataFrame, batch: DataFrame, keys: Sequence[str], time: str
) -> DataFrame:
    """Insert new keys; replace a row only by one with a strictly later ``time``."""
    both = _side_by_side(state, batch, keys)
    take_new = F.col("old").isNull() | _later(F.col("new")[time], F.col("old")[time])
    return _unpack(both, state, keys, take_new)


def merge_overwrite(state: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert new keys; a key in the batch always replaces the row in the state."""
    return _unpack(_side_by_side(state, batch, keys), state, keys, F.col("new").isNotNull())


def _unpack(both: DataFrame, state: DataFrame, keys: Sequence[str], take_new: Column) -> DataFrame:
    chosen = both.withColumn("row", F.when(take_new, F.col("new")).otherwise(F.col("old")))
    return chosen.select(
        *[c if c in keys else F.col("row")[c].alias(c) for c in state.columns]
    )


def merge_first_last(
    state: DataFrame,
    batch: DataFrame,
    key: str,
    first: str,
    last: str,
    last_attr: str,
    mode: str = "fold",
    last_id: str | None = None,
) -> DataFrame:
    """Widen each key's (first, last) span by the batch's span.

    ``fold`` moves both ends; running it again changes nothing, and with ``last_id``, the id
    of the row at the last time, equal last times go by it and the attribute, whichever came first. ``either``
    moves one end per run: the first time if it got earlier, otherwise the last
    time and its attribute if it got later.
    """
    both = _side_by_side(state, batch, [key])
    old, new = F.col("old"), F.col("new")
    inserted = old.isNull()
    starts_earlier = _earlier(new[first], old[first])
    ends_later = _later(new[last], old[last])
    if last_id and mode == "fold":
        same = new[last] == old[last]
        ends_later = ends_later | F.coalesce(
            same & (F.struct(id_order(new[last_id]), new[last_attr])
                    > F.struct(id_order(old[last_id]), old[last_attr])),
            F.lit(False),
        )
    if mode == "either":
        ends_later = ends_later & ~starts_earlier
    elif mode != "fold":
        raise ValueError(f"mode must be 'fold' or 'either', not {mode!r}")
    take_last = inserted | ends_later
    return both.select(
        key,
        F.when(inserted | starts_earlier, new[first]).otherwise(old[first]).alias(first),
        F.when(take_last, new[last]).otherwise(old[last]).alias(last),
        *[
            F.when(take_last, new[c]).otherwise(old[c]).alias(c)
            for c in (last_attr, last_id)
            if c
        ],
    )


def merge_first_last_ties(
    state: DataFrame, batch: DataFrame, key: str, first: str, last: str
) -> DataFrame:
    """Fold that keeps every row tied at the last time; either side may hold several per key."""
    return keep_last_ties(state.unionByName(batch), key, first, last)


def merge_pairs(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Distinct rows of both."""
    return state.unionByName(batch).distinct()


def new_pairs(state: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct rows of the batch whose key is not in the state."""
    return batch.distinct().join(state.select(*keys), list(keys), "left_anti")


def unseen(state: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``new_pairs`` for a large stored state: its rows are only looked up, never sorted or moved.

    The semi join passes the state by the batch's keys (sent to all tasks if they are small, behind
    Spark's runtime Bloom filter if its thresholds say so); what is left of it is no larger than the batch.
    """
    wanted = batch.distinct()
    known = state.select(*keys).join(wanted.select(*keys), list(keys), "left_semi")
    return wanted.join(known, list(keys), "left_anti")


CLAIM = ("time_s", "campaign_id", "user_id", "status")


def _per_voucher(rows: DataFrame) -> DataFrame:
    """(voucher_code, claim, low)."""
    claims = rows.filter(F.col("voucher_code").isNotNull()).groupBy("voucher_code")
    return claims.agg(F.max(F.struct(*CLAIM)).alias("claim"), F.min("actual_expire").alias("low"))


def _voucher_rows(merged: DataFrame, names: Sequence[str]) -> DataFrame:
    return merged.select(
        *[
            c if c == "voucher_code"
            else F.col("low").alias(c) if c == "actual_expire"
            else F.col("claim")[c].alias(c)
            for c in names
        ]
    )


def merge_vouchers(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Per voucher: the latest claim, with the earliest expiry over all its rows.

    Both sides may hold several rows per voucher. Equal claim times are decided
    by the largest campaign, user, then status. Rows without a voucher code belong to
    no voucher; ``split_null_keys`` gives them.
    """
    return _voucher_rows(_per_voucher(state.unionByName(batch)), state.columns)


def merge_into_vouchers(state: DataFrame, batch: DataFrame) -> DataFrame:
    """``merge_vouchers`` for a state with one row per voucher, which is joined instead of grouped again."""
    old = state.select("voucher_code", F.struct(*CLAIM).alias("old_claim"), F.col("actual_expire").alias("old_low"))
    both = old.join(_per_voucher(batch), "voucher_code", "full")
    claim, low = F.greatest("old_claim", "claim"), F.least("old_low", "low")
    return _voucher_rows(both.select("voucher_code", claim.alias("claim"), low.alias("low")), state.columns)
