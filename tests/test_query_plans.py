"""Shapes the physical plans must keep at scale."""

import re

import pytest

from pursefold import bindings as b
from pursefold.operators.cleaning import clean_transactions
from pursefold.operators.merge import merge_newer
from pursefold.plans import activity, profile
from pursefold.queries import QUERIES
from tests.test_oracles import SF_DIR

WRITES_FIRST = {
    "daily_run", "backfilled_lake_days", "profiles_text_ids", "raw_lake_text", "lake_by_folder",
    "voucher_daily", "history_load", "lake_mixed_types", "lake_typed_users", "surplus_cells",
    "malformed_lines", "backfill_folders", "arrivals_listed", "daily_report", "daily_either_rerun",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(plan, operator):
    return len(re.findall(rf"(?<!\w){operator} ", plan))


@pytest.fixture(scope="module")
def plans(spark):
    return {
        name: plan_of(build(spark, SF_DIR))
        for name, build in QUERIES.items()
        if name not in WRITES_FIRST
    }


def test_no_python_no_cross_join_no_single_task_window(plans):
    for name, plan in plans.items():
        for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert operator not in plan, (name, operator)
        assert not re.search(r"Window \[[^\]]*windowspecdefinition\(specified", plan), name


@pytest.mark.parametrize(
    "name, exchanges",
    [
        ("latest_profile", 1),
        ("first_last_payment", 1),
        ("first_last_activity", 1),
        ("user_apps", 1),
        ("promotion_status", 1),
        ("voucher_update", 1),
        ("promotion_expiry", 0),
        ("argmax_keep_ties", 1),
        ("promotion_expiry_voucher_min", 3),
        ("payment_merge_fold", 2),
        ("profile_merge_newer", 2),
        ("promotion_merge_overwrite", 2),
    ],
)
def test_shuffles(plans, name, exchanges):
    assert count(plans[name], "Exchange") == exchanges, plans[name]


def test_default_merges_need_no_window(plans):
    for name, plan in plans.items():
        assert "Window" not in plan, name


def test_building_a_query_starts_no_job_beyond_schemas(spark):
    tracker = spark.sparkContext.statusTracker()
    for name, build in QUERIES.items():
        if name in WRITES_FIRST:
            continue
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        build(spark, SF_DIR)
        jobs = tracker.getJobIdsForGroup(f"build-{name}")
        stages = [tracker.getStageInfo(s) for j in jobs for s in tracker.getJobInfo(j).stageIds]
        assert all(s.numTasks == 1 for s in stages), name  # a footer each
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_filters_and_columns_reach_the_lake_scan(spark, tmp_path):
    path = str(tmp_path / "txn")
    b.transactions(spark, SF_DIR).drop("is_new").write.parquet(path)
    txn = clean_transactions(spark.read.parquet(path))
    plan = plan_of(activity.first_last_payment(txn))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "EqualTo(trans_status,1)" in pushed and "EqualTo(trans_type,3)" in pushed
    plan = plan_of(activity.user_apps(txn))
    read = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"trans_status", "user_id", "app_id"}


def test_merge_joins_stored_tables_without_further_shuffles(spark, tmp_path):
    path = str(tmp_path / "profiles")
    profile.latest_profile(b.users(spark, SF_DIR), ["event_id"]).write.parquet(path)
    state, batch = spark.read.parquet(path), spark.read.parquet(path)
    plan = plan_of(merge_newer(state, batch, ["user_id"], "updated_time"))
    assert count(plan, "Exchange") == 2
