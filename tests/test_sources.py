import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException

from pursefold.operators import audit
from pursefold.schemas import (
    CAMPAIGNS,
    DAILY_ENTITIES,
    PAYMENT,
    PROMOTIONS,
    TRANSACTIONS,
    USER_PMC,
    USERS,
)
from pursefold.sources import lake, tsv
from pursefold.sources.state import StateStore
from tests.frames import rows, ts


def put(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write("".join(line + "\n" for line in lines))


def header(entity):
    return "\t".join(f.header for f in entity.fields)


def put_day(root, entity, day, *lines, part="part-0.csv"):
    put(f"{root}/{entity.folder}/{day}/{part}", header(entity), *lines)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "source")


@pytest.fixture
def lake_root(tmp_path):
    return str(tmp_path / "lake")


def test_read_entity(spark, root):
    put_day(
        root, PROMOTIONS, "2021-11-01",
        "7\tv1\tUSED\t3\t1635762030",
        "7\tv2\tGIVEN\tc3\t2021-11-01 10:20:30.987",
        "8\tv3",
    )
    got = tsv.read_entity(spark, root, PROMOTIONS, "2021-11-01")
    assert rows(got) == [
        ("7", "v1", "USED", 3, 1635762030), ("7", "v2", "GIVEN", None, 1635762030),
        ("8", "v3", None, None, None),
    ]


def test_header_in_another_order_fails(spark, root):
    put(f"{root}/users/2021-11-01/p.csv", "birthdate\tuserid\tprofileLevel\tgender\tupdatedTime",
        "1990-01-01\t1\t1\t1\t2021-11-01 00:00:00")
    with pytest.raises(Exception, match="header"):
        tsv.read_entity(spark, root, USERS, "2021-11-01").collect()


def test_has_rows(spark, root):
    put_day(root, USERS, "2021-11-01", "1\t1990-01-01\t1\t1\t2021-11-01 00:00:00")
    put_day(root, USERS, "2021-11-02")
    os.makedirs(f"{root}/users/2021-11-03")
    flags = [tsv.has_rows(spark, root, USERS, f"2021-11-0{n}") for n in (1, 2, 3, 4)]
    assert flags == [True, False, False, False]


def test_campaign_ids(spark, root):
    put(f"{root}/configs/c.csv", header(CAMPAIGNS), "7\t2\t2021-12-01 00:00:00\t3600",
        "08\t1\t2021-12-01 00:00:00.000\t60", "c7\t1\t2021-12-01 00:00:00\t60")
    got = tsv.read_campaigns(spark, f"{root}/configs")
    assert rows(got) == [
        (7, 2, ts("2021-12-01 00:00:00"), 3600),
        (8, 1, ts("2021-12-01 00:00:00"), 60),
        (None, 1, ts("2021-12-01 00:00:00"), 60),
    ]


def txn_line(n, user, time, status="1"):
    return f"t{n}\t{status}\t{user}\t{time}\t{n}\t3\t100\t1"


def test_writing_a_day_twice_leaves_the_lake_unchanged(spark, root, lake_root):
    put_day(root, USERS, "2021-11-01", "1\t1990-01-01\t1\t1\t2021-11-01 00:00:00.123")
    put_day(root, USERS, "2021-11-02", "2\t1990-01-01\t1\t1\t2021-11-02 00:00:00",
            "\t1990-01-01\t1\t1\t2021-11-02 00:00:00")
    for day in ("2021-11-01", "2021-11-02", "2021-11-01"):
        raw = tsv.read_raw(spark, tsv.day_path(root, USERS, day), USERS)
        lake.write_raw_day(raw, lake_root, USERS, day)
    assert lake.read_lake(spark, lake_root, USERS).count() == 3
    kept = lake.read_lake_day(spark, lake_root, USERS, "2021-11-01")
    assert rows(kept) == [("1", dt.date(1990, 1, 1), 1, 1, ts("2021-11-01 00:00:00.123"))]


def test_clean_day_and_partition_pruning(spark, root, lake_root):
    put_day(root, TRANSACTIONS, "2021-11-01", txn_line(1, 1, "2021-11-01 00:00:00.9"),
            txn_line(2, 1, "2021-11-01 00:00:01", status="0"))
    put_day(root, TRANSACTIONS, "2021-11-02", txn_line(3, 1, "2021-11-02 00:00:00"))
    for day in ("2021-11-01", "2021-11-02"):
        lake.write_clean_day(tsv.read_entity(spark, root, TRANSACTIONS, day), lake_root, day)
    got = lake.read_lake_day(spark, lake_root, TRANSACTIONS, "2021-11-01")
    assert rows(got, "trans_id", "txn_time") == [("t1", ts("2021-11-01 00:00:00"))]
    assert got.inputFiles() and all("store_date=2021-11-01" in f for f in got.inputFiles())
    assert lake.read_lake_day(spark, lake_root, TRANSACTIONS, "2020-01-01").count() == 0


def test_raw_days_keep_their_text(spark, root, lake_root):
    lines = ["007\t1990-13-01\tx\t1.0\tyesterday", "u1\t\t1\t1\t2021-11-01 00:00:00"]
    put_day(root, USERS, "2021-11-01", *lines)
    raw = tsv.read_raw(spark, tsv.day_path(root, USERS, "2021-11-01"), USERS)
    lake.write_raw_day(raw, lake_root, USERS, "2021-11-01")
    stored = spark.read.parquet(f"{lake_root}/users/store_date=2021-11-01")
    assert rows(stored) == rows(raw)
    assert rows(lake.read_lake_day(spark, lake_root, USERS, "2021-11-01")) == [
        ("007", None, None, 1, None), ("u1", None, 1, 1, ts("2021-11-01 00:00:00")),
    ]


def test_folders_that_name_no_day_are_left_alone(spark, root, lake_root):
    put_day(root, USERS, "2021-11-01", "1\t1990-01-01\t1\t1\t2021-11-01 00:00:00")
    put_day(root, USERS, "20211102", "2\t1990-01-01\t1\t1\t2021-11-01 00:00:00")
    lake.backfill(spark, root, lake_root, USERS)
    assert rows(lake.read_lake(spark, lake_root, USERS), "user_id") == [("1",)]


def test_a_lake_of_day_folders(spark, lake_root):
    text = spark.createDataFrame([("7", "v1", "USED", "3", "2021-11-01 10:20:30")], PROMOTIONS.raw_schema)
    for day in ("2021-11-01", "2021-11-02"):
        text.write.parquet(f"{lake_root}/promotions/{day}")
    assert rows(lake.read_foreign_lake(spark, lake_root, PROMOTIONS)) == [
        ("7", "v1", "USED", 3, 1635762030, dt.date(2021, 11, n)) for n in (1, 2)
    ]


def test_backfill_equals_day_by_day(spark, root, lake_root, tmp_path):
    days = ["2021-11-01", "2021-11-02", "2021-11-03"]
    for n, day in enumerate(days):
        put_day(root, TRANSACTIONS, day, txn_line(n, n, f"{day} 00:00:00.5"),
                txn_line(n + 10, n, f"{day} 00:00:00", status="0"))
        put_day(root, TRANSACTIONS, day, txn_line(n + 20, n, f"{day} 01:00:00"), part="part-1.csv")
        lake.write_clean_day(tsv.read_entity(spark, root, TRANSACTIONS, day), lake_root, day)
    other = str(tmp_path / "other")
    for _ in range(2):
        lake.backfill(spark, root, other, TRANSACTIONS)
    wanted = lake.read_lake(spark, lake_root, TRANSACTIONS)
    assert wanted.count() == 6
    assert rows(lake.read_lake(spark, other, TRANSACTIONS)) == rows(wanted)
    some = str(tmp_path / "some")
    lake.backfill(spark, root, some, TRANSACTIONS, days[:2])
    assert lake.read_lake(spark, some, TRANSACTIONS).count() == 4


def test_backfill_of_plain_files_named_by_day(spark, root, lake_root):
    for n in (1, 2):
        put(f"{root}/users/2021-11-0{n}", header(USERS), f"{n}\t1990-01-01\t1\t1\t2021-11-01 00:00:00")
    lake.backfill(spark, root, lake_root, USERS)
    assert rows(lake.read_lake(spark, lake_root, USERS), "user_id", "store_date") == [
        ("1", dt.date(2021, 11, 1)), ("2", dt.date(2021, 11, 2))
    ]
    assert set(DAILY_ENTITIES) == {"users", "transactions", "promotions"}


def test_state_versions(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    assert store.current_version(PAYMENT) == 0
    assert store.read(PAYMENT).count() == 0
    t = ts("2021-11-01 00:00:00")
    one = spark.createDataFrame([("1", t, t, 5, "a")], PAYMENT.ddl)
    assert store.publish(one, PAYMENT, "2021-11-01") == 1
    two = one.unionByName(spark.createDataFrame([("2", t, t, 6, "b")], PAYMENT.ddl))
    assert store.publish(two, PAYMENT, "2021-11-02") == 2
    assert store.current_version(PAYMENT) == 2
    assert rows(store.read(PAYMENT), "user_id") == [("1",), ("2",)]
    assert rows(store.read(PAYMENT, version=1), "user_id") == [("1",)]
    assert rows(store.versions(PAYMENT)) == [
        (1, dt.date(2021, 11, 1), 1), (2, dt.date(2021, 11, 2), 2)
    ]


@pytest.mark.parametrize("bad", [[("1", 1), ("1", 1)], [("1", None)]])
def test_a_table_with_a_broken_key_is_not_published(spark, tmp_path, bad):
    store = StateStore(spark, str(tmp_path / "state"))
    store.publish(spark.createDataFrame([("1", 1)], USER_PMC.ddl), USER_PMC)
    with pytest.raises(ValueError, match="user_pmc"):
        store.publish(spark.createDataFrame(bad, USER_PMC.ddl), USER_PMC)
    assert store.current_version(USER_PMC) == 1
    assert rows(store.read(USER_PMC)) == [("1", 1)]
    store.publish(spark.createDataFrame([("2", 2)], USER_PMC.ddl), USER_PMC)
    assert store.current_version(USER_PMC) == 2
    assert rows(store.read(USER_PMC)) == [("2", 2)]


def test_missing_lake_is_an_error(spark, lake_root):
    with pytest.raises(AnalysisException):
        lake.read_lake(spark, lake_root, USERS)


def test_malformed_lines(spark, root):
    put_day(root, PROMOTIONS, "2021-11-01", "7\tv1\tUSED\t3\t1", "8\tv2\tUSED\t3\t1\tx\ty", "9\tv3", '"a\tb"\tv4\tUSED\t3\t1')
    raw = tsv.read_raw(spark, tsv.day_path(root, PROMOTIONS, "2021-11-01"), PROMOTIONS, malformed=True)
    assert rows(raw.filter("malformed_line is not null"), "userid", "malformed_line") == [("8", "8\tv2\tUSED\t3\t1\tx\ty"), ("9", "9\tv3")]
    assert rows(raw.filter("malformed_line is null"), "userid") == [("7",), ("a\tb",)]
    lost = dict(rows(audit.parse_losses(raw, PROMOTIONS)))
    assert (lost["surplus_cells"], lost["missing_cells"]) == (1, 1)
    assert "surplus_cells" not in dict(rows(audit.parse_losses(raw.drop("malformed_line"), PROMOTIONS)))


def test_folders_passed_over_are_reported(spark, root, lake_root):
    line = "1\t1990-01-01\t1\t1\t2021-11-01 00:00:00"
    for folder in ("2021-11-01", "20211102", "2021-13-45", "2021-11-03/deeper"):
        put_day(root, USERS, folder, line)
    put(f"{root}/users/2021-11-04", header(USERS), line)
    put(f"{root}/users/notes.txt", "x")
    with pytest.warns(UserWarning, match="20211102"):
        found = lake.backfill(spark, root, lake_root, USERS)
    day = lambda n: dt.date(2021, 11, n)
    assert rows(found, "folder", "store_date", "n_files", "read") == [
        ("2021-11-01", day(1), 1, True), ("2021-11-03/deeper", None, 1, False), ("2021-11-04", day(4), 1, True),
        ("2021-13-45", None, 1, False), ("20211102", None, 1, False), ("notes.txt", None, 1, False),
    ]
    assert rows(lake.read_lake(spark, lake_root, USERS), "store_date") == [(day(1),), (day(4),)]
    plan = tsv.folders(spark, root, "users")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    assert tsv.folders(spark, root, "nothing").count() == 0


def test_backfill_keeps_malformed_lines(spark, root, lake_root):
    put_day(root, USERS, "2021-11-01", "1\t1990-01-01\t1\t1\t2021-11-01 00:00:00", "2\t1990-01-01")
    put_day(root, USERS, "2021-11-02", "3\t1990-01-01\t1\t1\t2021-11-01 00:00:00\tmore")
    lake.backfill(spark, root, lake_root, USERS)
    assert rows(lake.read_malformed(spark, lake_root, USERS)) == [
        ("2\t1990-01-01", dt.date(2021, 11, 1)), ("3\t1990-01-01\t1\t1\t2021-11-01 00:00:00\tmore", dt.date(2021, 11, 2)),
    ]
    assert lake.read_lake(spark, lake_root, USERS).count() == 3


def test_a_lake_whose_days_have_types_of_their_own(spark, lake_root):
    time = "timestamp '2021-11-01 10:20:30.5'"
    days = {
        "2021-11-01": f"'1' userid, date '1990-01-01' birthdate, '2' profileLevel, 1 gender, {time} updatedTime",
        "2021-11-02": "'2' userid, '1990-01-02' birthdate, 'x' profileLevel, '1.0' gender, '2021-11-02T00:00:00' updatedTime",
        "2021-11-03": "3 userid, '1990-01-03' birthdate, 4L PROFILELEVEL, 1735689600 updatedTime, 'y' other",
        "2021-11-04": f"'4' userid, {time} birthdate, 99999999999L profileLevel, true gender, cast({time} as timestamp_ntz) updatedTime",
    }
    for day, columns in days.items():
        spark.sql(f"select {columns}").write.parquet(f"{lake_root}/user/{day}")
    spark.sql("select 1 userid").write.parquet(f"{lake_root}/user/old")
    with pytest.warns(UserWarning, match="old"):
        got = lake.read_foreign_lake(spark, lake_root, USERS, "user")
    at = ts("2021-11-01 10:20:30.500000")
    assert rows(got.drop("store_date")) == [
        ("1", dt.date(1990, 1, 1), 2, 1, at), ("2", dt.date(1990, 1, 2), None, 1, ts("2021-11-02")),
        ("3", dt.date(1990, 1, 3), 4, None, ts("2025-01-01")), ("4", dt.date(2021, 11, 1), None, 1, at),
    ]
    assert rows(got, "store_date") == [(dt.date(2021, 11, n),) for n in (1, 2, 3, 4)]
    spark.sql("select '7' userid, 'v' voucherCode, 'A' status, 3 campaignID, timestamp '2021-11-01 10:20:30' time").write.parquet(f"{lake_root}/promotion/2021-11-01")
    assert rows(lake.read_foreign_lake(spark, lake_root, PROMOTIONS, "promotion").drop("store_date")) == [("7", "v", "A", 3, 1635762030)]
    with pytest.raises(FileNotFoundError):
        lake.read_foreign_lake(spark, lake_root, TRANSACTIONS)


def test_arrivals_from_listings(spark, root):
    put_day(root, USERS, "2021-11-01", "1\t1990-01-01\t1\t1\t2021-11-01 00:00:00")
    put_day(root, USERS, "2021-11-02", "1\t1990-01-01\t1\t1\t2021-11-01 00:00:00")
    os.makedirs(f"{root}/users/2021-11-03")
    put(f"{root}/users/2021-11-04/empty.csv")
    found = {e.folder: tsv.folders(spark, root, e.folder) for e in (USERS, PROMOTIONS)}
    got = audit.arrivals_listed(spark, found, "2021-11-01", "2021-11-04")
    assert rows(got.filter("present = 1"), "entity", "store_date", "n_files") == [("users", dt.date(2021, 11, n), 1) for n in (1, 2)]
    assert got.count() == 8 and got.filter("entity = 'users' and present = 1 and bytes > 50").count() == 2
