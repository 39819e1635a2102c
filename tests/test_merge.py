import datetime as dt

import pytest

from pursefold.operators.audit import arrivals, key_faults, require_key, stage_counts
from pursefold.operators.merge import (
    merge_first_last,
    merge_first_last_ties,
    merge_newer,
    merge_overwrite,
    merge_pairs,
    new_pairs,
)
from tests.frames import rows, spans, ts

D = {n: f"2021-01-{n:02d} 00:00:00" for n in range(1, 20)}


@pytest.fixture(scope="module")
def state(spark):
    return spans(
        spark,
        (1, D[5], D[10], 1),
        (2, D[5], D[10], 1),
        (3, D[5], D[10], 1),
        (4, D[5], D[10], 1),
        (5, D[5], D[10], 1),
        (7, D[5], D[10], 1),
        (8, None, None, 1),
    )


@pytest.fixture(scope="module")
def batch(spark):
    return spans(
        spark,
        (2, D[4], D[9], 2),     # only first earlier
        (3, D[4], D[11], 2),    # both wider
        (4, D[6], D[11], 2),    # only last later
        (5, D[5], D[10], 2),    # equal: no change
        (6, D[1], D[2], 2),     # not in the state
        (7, None, None, 2),     # no times
        (8, D[3], D[3], 2),     # state without times
    )


def fold(state, batch, mode="fold"):
    return merge_first_last(state, batch, "user_id", "first", "last", "attr", mode)


def at(first, last, attr):
    return ts(D[first]), ts(D[last]), attr


COMMON = {
    1: at(5, 10, 1), 2: at(4, 10, 1), 4: at(5, 11, 2), 5: at(5, 10, 1),
    6: at(1, 2, 2), 7: at(5, 10, 1),
}


def as_dict(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_fold_moves_both_ends(state, batch):
    assert as_dict(fold(state, batch)) == COMMON | {3: at(4, 11, 2), 8: at(3, 3, 2)}


def test_either_moves_one_end_per_run(state, batch):
    once = fold(state, batch, "either")
    assert as_dict(once) == COMMON | {3: at(4, 10, 1), 8: (ts(D[3]), None, 1)}
    again = fold(once, batch, "either")
    assert as_dict(again) == as_dict(fold(state, batch))


def test_fold_twice_changes_nothing(state, batch):
    once = fold(state, batch)
    assert rows(fold(once, batch)) == rows(once)


def test_unknown_mode(state, batch):
    with pytest.raises(ValueError):
        fold(state, batch, "both")


def test_fold_with_ties(spark, state):
    update = spans(spark, (1, D[10], D[10], 3), (2, D[12], D[12], 4), (2, D[12], D[12], 5))
    got = merge_first_last_ties(state.filter("user_id < 3"), update, "user_id", "first", "last")
    assert rows(got) == sorted(
        [(1, *at(5, 10, 1)), (1, *at(5, 10, 3)), (2, *at(5, 12, 4)), (2, *at(5, 12, 5))]
    )


PROFILE = "user_id bigint, level int, updated timestamp"


def profiles(spark, *items):
    return spark.createDataFrame([(k, v, ts(t)) for k, v, t in items], PROFILE)


def test_merge_newer(spark):
    old = profiles(spark, (1, 1, D[5]), (2, 1, D[5]), (3, 1, D[5]), (4, 1, None), (5, 1, D[5]))
    new = profiles(
        spark, (1, 2, D[4]), (2, 2, D[5]), (3, None, D[6]), (4, 2, D[1]), (5, 2, None), (6, 2, None)
    )
    merged = merge_newer(old, new, ["user_id"], "updated")
    assert {r.user_id: r.level for r in merged.collect()} == {1: 1, 2: 1, 3: None, 4: 2, 5: 1, 6: 2}
    assert rows(merge_newer(merged, new, ["user_id"], "updated")) == rows(merged)


def test_merge_overwrite(spark):
    shape = "user_id bigint, campaign_id bigint, status string, expired boolean"
    old = spark.createDataFrame([(1, 1, "A", True), (1, 2, "A", True)], shape)
    new = spark.createDataFrame([(1, 2, None, None), (2, 2, "B", False)], shape)
    merged = merge_overwrite(old, new, ["user_id", "campaign_id"])
    assert rows(merged) == [(1, 1, "A", True), (1, 2, None, None), (2, 2, "B", False)]


def test_pairs(spark):
    shape = "user_id bigint, app_id int"
    old = spark.createDataFrame([(1, 1), (1, 2)], shape)
    new = spark.createDataFrame([(1, 2), (1, 3), (1, 3), (2, 1)], shape)
    assert rows(merge_pairs(old, new)) == [(1, 1), (1, 2), (1, 3), (2, 1)]
    assert rows(new_pairs(old, new, ["user_id", "app_id"])) == [(1, 3), (2, 1)]


def test_key_faults(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 1), (None, 1)], "a int, b int")
    assert rows(key_faults(df, ["a"])) == [(5, 1, 2)]
    with pytest.raises(ValueError, match="1 repeated keys and 2 rows"):
        require_key(df, ["a"], "t")
    assert require_key(df.filter("a = 2"), ["a"], "t") == 1
    assert require_key(df.limit(0), ["a"], "t") == 0


def test_stage_counts(spark):
    assert rows(stage_counts(base=spark.range(3), empty=spark.range(0))) == [("base", 3), ("empty", 0)]


def test_arrivals(spark):
    def days(*names):
        return spark.createDataFrame([(dt.date.fromisoformat(n),) for n in names], "store_date date")

    seen = {"users": days("2021-11-01", "2021-11-01", "2021-12-01"), "promotions": days()}
    got = arrivals(spark, seen, "2021-11-01", "2021-11-02")
    assert rows(got) == [
        ("promotions", dt.date(2021, 11, 1), 0),
        ("promotions", dt.date(2021, 11, 2), 0),
        ("users", dt.date(2021, 11, 1), 1),
        ("users", dt.date(2021, 11, 2), 0),
    ]
