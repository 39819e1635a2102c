import datetime as dt
import random

import pytest

from pursefold.plans import activity, daily, profile, promotion
from pursefold.schemas import CAMPAIGNS, PROMOTIONS, TARGETS, TRANSACTIONS, USERS
from pursefold.sources import lake
from pursefold.sources.state import StateStore
from tests.frames import rows, ts
from tests.test_sources import header, put, put_day

DAYS = ["2021-11-01", "2021-11-02", "2021-11-03", "2021-11-04"]


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    """Four days; late rows reach into earlier days. No promotions on day 2, no users on day 3."""
    root = str(tmp_path_factory.mktemp("source"))
    rng = random.Random(11)

    def moment(day, n):
        at = dt.datetime.fromisoformat(day) - dt.timedelta(seconds=rng.randrange(200_000))
        return f"{at:%Y-%m-%d %H:%M:%S}.{n % 1000:03d}"

    serial = 0
    for day in DAYS:
        lines = {USERS: [], TRANSACTIONS: [], PROMOTIONS: []}
        for _ in range(60):
            serial += 1
            user = rng.choice(["", *map(str, range(12))])
            lines[USERS].append(f"{user}\t199{serial % 10}-01-01\t{serial % 4}\t1\t{moment(day, serial)}")
            lines[TRANSACTIONS].append(
                f"t{serial:05d}\t{rng.choice('110')}\t{user}\t{moment(day, serial)}\t"
                f"{rng.randrange(5)}\t{rng.randrange(1, 5)}\t100\t{rng.choice(['', '1', '2'])}"
            )
            lines[PROMOTIONS].append(
                f"{user}\tv{rng.randrange(30)}\t{rng.choice('AB')}\t{rng.randrange(4)}\t"
                f"{1635724800 + serial * 1000}"
            )
        if day == DAYS[1]:
            lines[PROMOTIONS] = []
        if day == DAYS[2]:
            del lines[USERS]
        for entity, text in lines.items():
            put_day(root, entity, day, *text)
    put(f"{root}/{CAMPAIGNS.folder}/c.csv", header(CAMPAIGNS),
        *[f"{n}\t{1 + n % 2}\t2021-11-05 00:00:00\t{86400 * n}" for n in range(4)])
    return root


def run(spark, source, where, days, **options):
    store = StateStore(spark, str(where / "state"))
    reports = [
        dict(rows(daily.run_day(spark, source, str(where / "lake"), store, day, **options)))
        for day in days
    ]
    return store, reports


def tables(store, names=TARGETS):
    return {name: rows(store.read(TARGETS[name])) for name in names}


FOLDED = ("user_info", "payment", "active", "user_app", "user_pmc")


@pytest.fixture(scope="module")
def in_order(spark, source, tmp_path_factory):
    where = tmp_path_factory.mktemp("run")
    store, reports = run(spark, source, where, DAYS)
    return store, reports, where


def test_days_equal_one_load_of_everything(spark, source, in_order, tmp_path):
    store, _, where = in_order
    for entity in (USERS, TRANSACTIONS):
        lake.backfill(spark, source, str(tmp_path), entity)
    txn = lake.read_lake(spark, str(tmp_path), TRANSACTIONS)
    got = tables(store)
    assert got["payment"] == rows(activity.first_last_payment(txn))
    assert got["active"] == rows(activity.first_last_activity(txn))
    assert got["user_app"] == rows(activity.user_apps(txn))
    assert got["user_pmc"] == rows(activity.user_payment_sources(txn))
    users = lake.read_lake(spark, str(tmp_path), USERS)
    assert got["user_info"] == rows(profile.latest_profile(users))
    for first, last in [r[1:3] for r in got["payment"] + got["active"]]:
        assert first <= last
    assert len(got["user_promotion"]) > 10


def test_report(in_order):
    _, reports, _ = in_order
    assert reports[0]["users.rows"] == 60
    assert 0 < reports[0]["users.rejected"] < 30
    assert "promotions.rows" not in reports[1] and "users.rows" not in reports[2]
    assert reports[3]["user_info.rows"] == 12
    assert reports[0]["transactions.rows"] < 60
    assert reports[0]["user_pmc.rejected"] > reports[0]["user_app.rejected"] == 0


def test_unreadable_cells_are_reported(spark, tmp_path):
    root = str(tmp_path / "source")
    put_day(root, USERS, DAYS[0], "1\t1990-13-01\t1\t1\tyesterday", "u2\t\t1\t1\t2021-11-01 00:00:00")
    store, (report,) = run(spark, root, tmp_path, [DAYS[0]])
    lost = {stage: n for stage, n in report.items() if ".lost." in stage}
    assert lost == {"users.lost.birthdate": 1, "users.lost.updated_time": 1}
    assert tables(store, ["user_info"])["user_info"] == [
        ("1", None, 1, 1, None), ("u2", None, 1, 1, ts("2021-11-01 00:00:00")),
    ]


def test_rerun_changes_nothing(spark, source, in_order):
    store, _, where = in_order
    before = tables(store)
    lake_rows = lake.read_lake(spark, str(where / "lake"), USERS).count()
    run(spark, source, where, [DAYS[-1]])
    assert tables(store) == before
    assert lake.read_lake(spark, str(where / "lake"), USERS).count() == lake_rows


def test_days_out_of_order(spark, source, in_order, tmp_path):
    store, _ = run(spark, source, tmp_path, [DAYS[n] for n in (2, 0, 3, 1)])
    assert tables(store, FOLDED) == tables(in_order[0], FOLDED)


def test_absent_day(spark, source, tmp_path):
    store, reports = run(spark, source, tmp_path, ["2020-01-01"])
    assert reports == [{}]
    assert store.current_version(TARGETS["payment"]) == 0


def test_repeated_campaign_id_is_refused(spark, tmp_path):
    root = str(tmp_path / "source")
    put_day(root, PROMOTIONS, DAYS[0], "1\tv\tA\t7\t1635724800")
    put(f"{root}/{CAMPAIGNS.folder}/c.csv", header(CAMPAIGNS),
        "7\t1\t2021-11-05 00:00:00\t1", "x\t1\t\t1", "07\t1\t2021-11-05 00:00:00\t1")
    with pytest.raises(ValueError, match="configs"):
        run(spark, root, tmp_path, [DAYS[0]])


def test_expired_uses_as_of(spark, tmp_path):
    root = str(tmp_path / "source")
    put_day(root, PROMOTIONS, DAYS[0], "1\tv\tA\t7\t1635724800")
    put(f"{root}/{CAMPAIGNS.folder}/c.csv", header(CAMPAIGNS), "7\t1\t2021-11-05 00:00:00\t1")
    for as_of, expired in ((None, False), ("2021-11-06", True)):
        store, _ = run(spark, root, tmp_path, [DAYS[0]], as_of=as_of, again=True)
        assert tables(store)["user_promotion"] == [("1", 7, "A", expired)]


def test_store_date_is_the_day_before():
    assert daily.store_date_for(dt.date(2022, 3, 1)) == dt.date(2022, 2, 28)
    assert ts("2022-02-28").date() == dt.date(2022, 2, 28)


def test_a_day_that_was_cut_off_can_be_repeated(spark, source, tmp_path, monkeypatch):
    """Some tables have the day, others not; in either mode a second merge would move further ends."""
    whole, _ = run(spark, source, tmp_path / "whole", DAYS, mode="either")
    store = StateStore(spark, str(tmp_path / "cut" / "state"))
    enter = StateStore._enter

    def cut(self, target, *rest, **more):
        if target.name in ("user_pmc", "active", "voucher"):
            raise OSError("the day is cut off")
        return enter(self, target, *rest, **more)

    lake_root = str(tmp_path / "cut" / "lake")
    for day in DAYS:
        with monkeypatch.context() as patch:
            patch.setattr(StateStore, "_enter", cut)
            with pytest.raises(OSError):
                daily.run_day(spark, source, lake_root, store, day, mode="either")
        for _ in range(2):
            daily.run_day(spark, source, lake_root, store, day, mode="either")
    assert tables(store) == tables(whole)


def test_a_repeated_day_is_not_merged_again(spark, source, in_order, tmp_path):
    store, (first, second) = run(spark, source, tmp_path, [DAYS[0]] * 2)
    assert {s for s in first if s not in second} == {f"{t}.rows" for t in TARGETS} | {"promotions.unknown_campaign"}
    assert store.current_version(TARGETS["payment"]) == 1
    run(spark, source, tmp_path, [DAYS[0]], again=True)
    assert store.current_version(TARGETS["payment"]) == 2


def test_lines_with_surplus_or_missing_cells_are_kept_and_reported(spark, tmp_path):
    root = str(tmp_path / "source")
    lines = ["1\t1990-01-01\t1\t1\t2021-11-01 00:00:00\tmore\tcells", "2\t1990-01-01", "3\t1990-01-01\t1\t1\t2021-11-01 00:00:00"]
    put_day(root, USERS, DAYS[0], *lines)
    put_day(root, TRANSACTIONS, DAYS[0], "t1\t1\t1\t2021-11-01 00:00:00\t5\t3\t100\t1\tx", "t2\t0\t1")
    store, (report,) = run(spark, root, tmp_path, [DAYS[0]])
    lost = {stage: n for stage, n in report.items() if ".lost." in stage}
    assert lost == {f"{e}.lost.{kind}_cells": 1 for e in ("users", "transactions") for kind in ("surplus", "missing")}
    day = dt.date.fromisoformat(DAYS[0])
    assert rows(lake.read_malformed(spark, str(tmp_path / "lake"), USERS)) == [(line, day) for line in lines[:2]]
    assert lake.read_malformed(spark, str(tmp_path / "lake"), TRANSACTIONS).count() == 2
    assert lake.read_malformed(spark, str(tmp_path / "lake"), PROMOTIONS).count() == 0
    assert [r[0] for r in tables(store, ["user_info"])["user_info"]] == ["1", "2", "3"]
    assert len(tables(store, ["payment"])["payment"]) == 1


def test_the_report_reads_no_data(spark, source, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    report = daily.run_day(spark, source, str(tmp_path / "lake"), store, DAYS[0])
    assert "FileScan" not in report._jdf.queryExecution().executedPlan().toString()
    counted = dict(rows(report))
    day = lake.read_lake_day(spark, str(tmp_path / "lake"), PROMOTIONS, DAYS[0])
    assert counted["promotions.rows"] == day.count()
    assert counted["promotions.rejected"] == day.filter("user_id is null or campaign_id is null").count()
    txn = lake.read_lake_day(spark, str(tmp_path / "lake"), TRANSACTIONS, DAYS[0])
    assert counted["transactions.rows"] == txn.count()
    assert counted["user_pmc.rejected"] == txn.filter("user_id is not null and pmc_id is null").count()
    assert counted["promotions.unknown_campaign"] == 0 and counted["configs.rejected"] == 0


def test_a_day_of_claims_meets_its_campaigns_once(spark, source, tmp_path, monkeypatch):
    """Both tables of claims read what one join has written, and a day that they have makes none."""
    joins, join = [], promotion.promotion_with_campaign
    monkeypatch.setattr(promotion, "promotion_with_campaign", lambda *a, **k: joins.append(1) or join(*a, **k))
    run(spark, source, tmp_path, [DAYS[0], DAYS[2], DAYS[2]], as_of="2021-11-05")
    assert len(joins) == 2
    assert not list((tmp_path / "state").glob("claims*"))
