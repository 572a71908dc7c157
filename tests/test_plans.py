"""What the physical plans must and must not contain."""

import re

import pytest

from registry.queries import all_queries
from tidemark.sources.events import read_account_tables

QUERIES = all_queries()
LAZY = [n for n in QUERIES
        if not n.startswith(("incremental", "mart_", "arrivals_")) and n not in
        ("check_summary", "check_stored_failures", "check_not_null", "changed_rows",
         "development_limit", "schema_guard", "base_views")]

BROADCASTS_DATES = ("open_accounts_by_date", "user_activity_by_date", "user_drilldown",
                    "user_drilldown_on_date", "active_user_rate_expanded")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are when no side is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_joins_and_no_python(spark, smallest, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, smallest))
    for operator in ("NestedLoop", "CartesianProduct", "Python", "Pandas"):
        assert operator not in plan
    # Only the distinct calculation dates are ever broadcast.
    for line in plan.splitlines():
        if "BroadcastExchange" in line:
            assert name in BROADCASTS_DATES and "input[0, date, true]" in line


def test_scans_read_needed_columns_and_push_filters(spark, smallest):
    plan = plan_of(read_account_tables(spark, smallest).closed)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    assert "EqualTo(event_type,error)" in plan


def test_account_partitioning_is_shared(spark, smallest, no_broadcast):
    """Pairs, flag and totals meet on the account: one exchange by account per input."""
    plan = plan_of(QUERIES["unified_accounts"](spark, smallest))
    by_account = re.findall(r"hashpartitioning\(account_id_hashed#\d+, \d+\)", plan)
    assert len(by_account) == 3


def test_only_the_daily_sums_reach_one_task(spark, smallest, no_broadcast):
    plan = plan_of(QUERIES["active_user_rate"](spark, smallest))
    assert plan.count("SinglePartition") == 1
    below = plan[plan.index("SinglePartition"):].splitlines()[1]
    assert re.search(r"HashAggregate\(keys=\[day#\d+\]", below)


def test_drilldown_filters_the_accounts_first(spark, smallest, no_broadcast):
    """The user filter sits below the shuffle that brings the accounts together."""
    plan = plan_of(QUERIES["user_drilldown"](spark, smallest))
    exchange = plan.index("Exchange hashpartitioning(account_id_hashed")
    assert "user-1" in plan[exchange:]


def exchanges(plan):
    return len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange ", plan))


def static_plan(spark, name, folder):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return plan_of(QUERIES[name](spark, folder))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name, most", [
    ("current_account_status", 12), ("user_activity_by_date", 18), ("active_user_rate", 18),
    ("active_user_rate_as_of", 13)])
def test_rows_without_id_double_no_branch(spark, smallest, no_broadcast, name, most):
    assert exchanges(static_plan(spark, name, smallest)) <= most


def test_children_meet_their_parent_in_one_exchange(spark, smallest, no_broadcast):
    """Two exchanges derive the tables from events, one is the check's, and nothing is joined."""
    plan = static_plan(spark, "check_relationships", smallest)
    assert exchanges(plan) == 3 and "Join" not in plan


def test_the_suite_counts_each_table_once(spark, smallest, no_broadcast):
    """A shuffle per table with keys, one for all relations, three for totals, one for the sum."""
    plan = static_plan(spark, "check_summary", smallest)
    assert exchanges(plan) <= 10 and "SinglePartition" not in plan
    # Row rules and freshness were counted while the tables were written.
    assert "count_if" not in plan.replace("count_if(judged", "").replace("count_if((place", "")
