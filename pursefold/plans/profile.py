"""Latest profile per user."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pursefold.functions.parsing import to_second
from pursefold.functions.rules import age_years
from pursefold.operators.keyed import latest_by_key
from pursefold.operators.merge import merge_newer
from pursefold.schemas import USER_INFO

PROFILE_COLUMNS = USER_INFO.names


def latest_profile(users: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest profile per user, to the second; ``tiebreak`` names further columns of ``users``."""
    profiles = users.filter(F.col("user_id").isNotNull()).select(
        *[to_second(F.col(c)).alias(c) if c == "updated_time" else c for c in PROFILE_COLUMNS],
        *tiebreak,
    )
    return latest_by_key(profiles, ["user_id"], ["updated_time", *tiebreak]).drop(*tiebreak)


def profile_update(state: DataFrame, users: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Merge a batch of profile rows; only a strictly newer profile replaces the stored one."""
    return merge_newer(state, latest_profile(users, tiebreak), ["user_id"], "updated_time")


def profile_merge_union(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Same table by union and latest row, both sides cut to the second.

    Differs from ``profile_update`` only for profiles of equal time.
    """
    return latest_profile(state.unionByName(batch))


def with_age(profile: DataFrame, as_of: dt.date | str) -> DataFrame:
    return profile.withColumn("age", age_years(F.col("birthdate"), as_of))
