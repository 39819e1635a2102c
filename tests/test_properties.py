"""Laws the merges obey on any input."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from pursefold.operators.keyed import first_last_by_key, latest_by_key
from pursefold.operators.merge import (
    merge_first_last,
    merge_first_last_ties,
    merge_newer,
    merge_pairs,
    merge_vouchers,
)
from pursefold.schemas import VOUCHER
from tests.frames import rows

FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
START = dt.datetime(2021, 1, 1)
seconds = st.one_of(st.none(), st.integers(0, 6).map(lambda n: START + dt.timedelta(seconds=n)))
keys = st.integers(1, 5)
events = st.lists(st.tuples(st.text("ab", max_size=2), keys, seconds, st.integers(0, 3)), max_size=25)

TXN = "trans_id string, user_id bigint, t timestamp, app int"
SPAN = {"first": "first", "last": "last", "last_attr": "attr"}


def transactions(spark, data):
    """Transaction ids are made unique, as they are in the feeds."""
    return spark.createDataFrame([(f"{i}{n:03d}", *rest) for n, (i, *rest) in enumerate(data)], TXN)


def spans(txn):
    return first_last_by_key(txn, "user_id", "t", "app", tiebreak="trans_id", last_id="last_id", **SPAN)


def fold(state, batch):
    return merge_first_last(state, batch, "user_id", "first", "last", "attr", last_id="last_id")


def by_hand(data):
    wanted = {}
    for _, key, t, _ in data:
        if t is not None:
            first, last = wanted.get(key, (t, t))
            wanted[key] = min(first, t), max(last, t)
    return sorted((k, *v) for k, v in wanted.items())


@FEW
@given(data=events)
def test_spans(spark, data):
    txn = transactions(spark, data)
    got = spans(txn)
    assert rows(got, "user_id", "first", "last") == by_hand(data)
    assert rows(spans(txn.repartition(5, "app").sortWithinPartitions("t"))) == rows(got)


@FEW
@given(data=events, cut=st.integers(0, 25))
def test_fold_of_days_is_fold_of_everything(spark, data, cut):
    whole = transactions(spark, data)
    early = F.substring("trans_id", -3, 3).cast("int") < cut
    base, update = spans(whole.filter(early)), spans(whole.filter(~early))
    merged = fold(base, update)
    assert rows(merged, "user_id", "first", "last") == by_hand(data)
    assert rows(fold(merged, update)) == rows(merged)
    other = fold(update, base)
    assert rows(other) == rows(merged) == rows(spans(transactions(spark, data)))


@FEW
@given(data=events, cut=st.integers(0, 25))
def test_profiles(spark, data, cut):
    def latest(part):
        return latest_by_key(transactions(spark, part).drop("trans_id"), ["user_id"], ["t"])

    state, batch = latest(data[:cut]), latest(data[cut:])
    merged = merge_newer(state, batch, ["user_id"], "t")
    assert rows(merge_newer(merged, batch, ["user_id"], "t")) == rows(merged)
    assert rows(merged, "user_id", "t") == rows(latest(data), "user_id", "t")


@FEW
@given(
    left=st.lists(st.tuples(keys, keys), max_size=15), right=st.lists(st.tuples(keys, keys), max_size=15)
)
def test_pairs(spark, left, right):
    shape = "user_id bigint, app_id int"
    a, b = spark.createDataFrame(left, shape), spark.createDataFrame(right, shape)
    assert rows(merge_pairs(a, b)) == sorted(set(left) | set(right))


@FEW
@given(data=events, cut=st.integers(0, 25))
def test_vouchers(spark, data, cut):
    def claims(part):
        return spark.createDataFrame(
            [(f"v{k}", k, app, i, n, t) for n, (i, k, t, app) in enumerate(part)], VOUCHER.ddl
        )

    state, batch = claims(data[:cut]), claims(data[cut:])
    merged = merge_vouchers(state, batch)
    assert rows(merge_vouchers(merged, batch)) == rows(merged)
    assert rows(merge_vouchers(batch, state)) == rows(merged)


@FEW
@given(data=events, cut=st.integers(0, 25))
def test_tied_fold(spark, data, cut):
    def seeded(part):
        shape = "user_id bigint, first timestamp, last timestamp, attr int"
        return spark.createDataFrame([(k, t, t, a) for _, k, t, a in part], shape)

    got = merge_first_last_ties(seeded(data[:cut]), seeded(data[cut:]), "user_id", "first", "last")
    ends = {key: (first, last) for key, first, last in by_hand(data)}
    wanted = [(k, *ends[k], a) for _, k, t, a in data if t is not None and t == ends[k][1]]
    assert rows(got) == sorted(wanted, key=lambda row: tuple(map(str, row)))
