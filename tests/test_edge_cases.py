"""The hand-made cases E1 to E16 of FIXTURES.md section 5."""

import pytest

from build import spark_tables, ts, written
from tidemark.operators import activity, lifecycle
from tidemark.operators.closures import deduplicate_closures, latest_closure_per_day
from tidemark.plans import marts


def account(name="a", user="u", created="1 08:00"):
    return (name, user, "uk_retail", created)


def unified(spark, **rows):
    rows.setdefault("created", [account()])
    result = marts.unified_accounts(spark_tables(spark, written(**rows))).collect()
    return sorted(
        ((r.closed_ts, r.reopened_ts, r.account_status, r.total_transactions,
          r.multiple_closures_without_reopen_flag) for r in result),
        key=str)


def test_e1_no_events(spark):
    assert unified(spark) == [(None, None, "open", 0, 0)]


def test_e2_two_closures_on_a_day(spark):
    assert unified(spark, closed=[("a", "2 10:00"), ("a", "2 10:30")]) == [
        (ts("2 10:30"), None, "closed", 0, 0)]


def test_e3_around_midnight(spark):
    rows = [("a", "2 23:50"), ("a", "3 00:10")]
    assert unified(spark, closed=rows) == [
        (ts("2 23:50"), None, "closed", 0, 1), (ts("3 00:10"), None, "closed", 0, 1)]
    t = spark_tables(spark, written(closed=rows))
    assert deduplicate_closures(t.closed, "gap").count() == 2


def test_e4_far_apart_on_a_day(spark):
    t = spark_tables(spark, written(closed=[("a", "2 09:00"), ("a", "2 17:00")]))
    assert [r.closed_ts for r in latest_closure_per_day(t.closed).collect()] == [ts("2 17:00")]
    assert deduplicate_closures(t.closed, "gap").count() == 2


def test_e5_reopen_between_closures_of_a_day(spark):
    assert unified(spark, closed=[("a", "2 09:00"), ("a", "2 17:00")],
                   reopened=[("a", "2 12:00")]) == [(ts("2 17:00"), None, "closed", 0, 0)]


def test_e6_close_reopen_close(spark):
    assert unified(spark, closed=[("a", "2 09:00"), ("a", "4 09:00")],
                   reopened=[("a", "3 09:00")]) == [
        (ts("2 09:00"), ts("3 09:00"), "reopened", 0, 1),
        (ts("4 09:00"), None, "closed", 0, 1)]


def test_e7_close_close_reopen(spark):
    assert unified(spark, closed=[("a", "2 09:00"), ("a", "4 09:00")],
                   reopened=[("a", "5 09:00")]) == [
        (ts("2 09:00"), ts("5 09:00"), "reopened", 0, 0),
        (ts("4 09:00"), ts("5 09:00"), "reopened", 0, 0)]


def test_e7_strict_reading_finds_the_unanswered_closure(spark):
    t = spark_tables(spark, written(
        created=[account()], closed=[("a", "2 09:00"), ("a", "4 09:00")],
        reopened=[("a", "5 09:00")]))
    pairs = lifecycle.closure_reopen_pairs(t.created, t.closed, t.reopened)
    assert [r.num_unreopened_before_next
            for r in lifecycle.consecutive_closures(pairs).collect()] == [1]


def test_e8_reopen_at_the_same_moment(spark):
    assert unified(spark, closed=[("a", "2 09:00")], reopened=[("a", "2 09:00")]) == [
        (ts("2 09:00"), None, "closed", 0, 0)]
    assert unified(spark, closed=[("a", "2 09:00")],
                   reopened=[("a", "2 09:00"), ("a", "2 09:00:00.000001")]) == [
        (ts("2 09:00"), ts("2 09:00:00.000001"), "reopened", 0, 0)]


def test_e9_reopen_without_closure(spark):
    assert unified(spark, reopened=[("a", "2 09:00")]) == [(None, None, "open", 0, 0)]


def rates(spark, min_transactions=None, **rows):
    rows.setdefault("created", [account()])
    t = spark_tables(spark, written(**rows))
    return {r.calculation_date.day: (r.active_users, r.total_open_users)
            for r in marts.active_user_rate(t, min_transactions=min_transactions).collect()}


def test_e10_window_of_eight_dates(spark):
    other = ("x", 1, "10")
    assert rates(spark, transactions=[("a", 1, "3"), other])[10] == (1, 1)
    assert rates(spark, transactions=[("a", 1, "2"), other])[10] == (0, 1)


def test_e11_rows_count_even_when_zero(spark):
    assert rates(spark, transactions=[("a", 0, "3")])[3] == (1, 1)
    assert rates(spark, min_transactions=1, transactions=[("a", 0, "3")])[3] == (0, 1)


def test_e12_not_open_after_the_closure_day(spark):
    got = rates(spark, closed=[("a", "3 09:00")], reopened=[("a", "5 09:00")],
                transactions=[("x", 1, d) for d in ("1", "3", "4", "6")])
    assert got == {1: (0, 1), 3: (0, 1)}


def test_e12_as_of_sees_the_reopening(spark):
    t = spark_tables(spark, written(
        created=[account()], closed=[("a", "3 09:00")], reopened=[("a", "5 09:00")],
        transactions=[("x", 1, d) for d in ("1", "3", "4", "5", "6")]))
    got = {r.calculation_date.day: r.total_open_users
           for r in marts.active_user_rate_as_of(t).collect()}
    assert got == {1: 1, 3: 1, 5: 1, 6: 1}


def test_e13_created_and_closed_on_the_date(spark):
    day = [("x", 1, "1")]
    assert rates(spark, closed=[("a", "1 09:00")], transactions=day) == {}
    assert rates(spark, closed=[("a", "1 09:00")], reopened=[("a", "2 09:00")],
                 transactions=day) == {1: (0, 1)}


def test_e14_events_of_unknown_accounts(spark):
    assert unified(spark, closed=[("x", "2 09:00")], transactions=[("x", 3, "2")]) == [
        (None, None, "open", 0, 0)]


def test_e15_closure_without_timestamp(spark):
    assert unified(spark, closed=[("a", None), ("a", None)], reopened=[("a", "2 09:00")]) == [
        (None, None, "open", 0, 0)]


def test_e16_shared_account_id(spark):
    got = unified(spark, created=[account(user="u"), account(user="v", created="1 09:00")],
                  closed=[("a", "2 09:00"), ("a", "3 09:00")])
    assert len(got) == 8 and {r[4] for r in got} == {1}


def test_a_week_of_long_spans_costs_no_rows(spark):
    """An account created long before the first date counts on every date."""
    old = ("a", "u", "uk_retail", "-3000")
    assert rates(spark, created=[old], transactions=[("x", 1, "1"), ("a", 1, "20")]) == {
        1: (0, 1), 20: (1, 1)}


def test_drilldown_on_a_date(spark):
    t = spark_tables(spark, written(created=[account(), account("b", "v")],
                                    transactions=[("a", 1, "2"), ("b", 1, "3")]))
    users = activity.user_activity_by_date(marts.open_spans(t), t.transactions)
    assert activity.user_drilldown(users, "u").count() == 2
    row = activity.user_drilldown(users, "u", "2024-01-02").collect()
    assert [(r.open_accounts, r.transactions_in_last_7_days) for r in row] == [(1, 1)]


@pytest.mark.parametrize("call", [
    lambda df: deduplicate_closures(df, "hour"),
    lambda df: deduplicate_closures(df, "gap", gap_seconds=0),
    lambda df: lifecycle.account_status(df, states=4),
])
def test_bad_parameters(spark, call):
    t = spark_tables(spark, {})
    with pytest.raises(ValueError):
        call(t.closed)
