"""Reductions to one row (or the tied rows) per key.

They aggregate map-side first, so a key holding a large share of the rows costs
each task one partial row. Where rows must be kept, the aggregate is joined back
to them: a join whose large partitions adaptive execution splits, so that no
task has to hold a key whole. It only does so where both sides are shuffled for
the join, so the key is joined as a struct, by which the aggregate is not dealt yet.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pursefold.functions.parsing import to_long


def any_null(keys: Sequence[str]):
    return reduce(or_, [F.col(k).isNull() for k in keys])


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a full key, rejected rows)."""
    missing = any_null(keys)
    return df.filter(~missing), df.filter(missing)


def id_order(id: Column) -> Column:
    """By which ids are compared, stored ones as well: whole numbers by value, after all others,
    which go by their text."""
    text = id.cast("string")
    return F.struct(to_long(text).alias("number"), text.alias("text"))


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str],
) -> DataFrame:
    """The row with the largest ``newest`` values per key, NULL counting as oldest.

    Rows that tie on all of ``newest`` are told apart by their other columns,
    so the choice never depends on row order.
    """
    keys, newest = list(keys), list(newest)
    rest = [c for c in df.columns if c not in keys and c not in newest]
    best = F.max(F.struct(*newest, *rest)).alias("best")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(*[c if c in keys else F.col("best")[c].alias(c) for c in df.columns])


def first_last_by_key(
    df: DataFrame,
    key: str,
    time: str,
    attr: str,
    first: str,
    last: str,
    last_attr: str,
    tiebreak: str | None = None,
    last_id: str | None = None,
) -> DataFrame:
    """First time, last time and the attribute at the last time, in one pass.

    Among rows at the same last time the last ``tiebreak`` id (see ``id_order``), then the
    largest attribute, decides; ``last_id`` names a column for that id. Keys without any
    time do not appear.
    """
    order = [id_order(F.col(tiebreak)).alias("id")] if tiebreak else []
    end = F.max(F.struct(F.col(time), *order, F.col(attr))).alias("end")
    spans = (
        df.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
        .groupBy(key)
        .agg(F.min(time).alias(first), end)
    )
    return spans.select(
        key,
        first,
        F.col("end")[time].alias(last),
        F.col("end")[attr].alias(last_attr),
        *([F.col("end")["id"]["text"].alias(last_id)] if last_id and tiebreak else []),
    )


def seed_first_last(
    df: DataFrame, key: str, time: str, attr: str, first: str, last: str, last_attr: str
) -> DataFrame:
    """One span per event: first = last = its time."""
    return df.select(
        key,
        F.col(time).alias(first),
        F.col(time).alias(last),
        F.col(attr).alias(last_attr),
    )


def _joined_back(df: DataFrame, values: DataFrame, key: str, how: str) -> DataFrame:
    """``values``, one row per key, beside the rows of the key; their key column drops out."""
    of_key = values.withColumn("of_key", F.struct(key)).drop(key)
    return df.join(of_key, F.struct(df[key]) == F.col("of_key"), how)


def keep_last_ties(spans: DataFrame, key: str, first: str, last: str) -> DataFrame:
    """Every row standing at its key's last time, with the key's first time."""
    full = spans.filter(F.col(key).isNotNull())
    ends = full.groupBy(key).agg(
        F.min(first).alias("first_of_key"), F.max(last).alias("last_of_key")
    )
    at_end = _joined_back(full, ends, key, "inner").filter(F.col(last) == F.col("last_of_key"))
    return at_end.select(
        *[F.col("first_of_key").alias(c) if c == first else F.col(c) for c in spans.columns]
    )


def with_group_min(df: DataFrame, key: str, value: str) -> DataFrame:
    """Replace ``value`` by its minimum over the key; rows without a key keep their own."""
    low = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias("low"))
    return _joined_back(df, low, key, "left").select(
        *[F.coalesce("low", c).alias(c) if c == value else F.col(c) for c in df.columns]
    )
