"""Random tables, some with a hot account and user, against the SQL texts."""

import pytest

from build import drawn, duck_tables, spark_tables
from compare import duck_rows, spark_rows
from registry import oracle
from registry.queries import _activity, _pairs
from tidemark.operators import activity, lifecycle, reporting
from tidemark.operators.closures import closures_without_close_successor, latest_closure_per_day
from tidemark.plans import marts

# The texts name the four tables; here they exist, so the part deriving them from events goes.
TEXTS = {name: text.replace(oracle.SOURCES.strip() + ",", "", 1)
         for name, text in oracle.texts().items()}

QUERIES = {
    "closures_latest_per_day": lambda t: latest_closure_per_day(t.closed),
    "closures_gap_dedupe": lambda t: closures_without_close_successor(
        t.closed.filter("closed_ts IS NOT NULL")),
    "closure_reopen_pairs": _pairs,
    "account_status_rows": marts.status_rows,
    "multiple_closures_without_reopen": lambda t: lifecycle.multiple_closures(_pairs(t)),
    "unified_accounts": marts.unified_accounts,
    "open_accounts_by_date": lambda t: activity.open_accounts_by_date(
        marts.open_spans(t), activity.calculation_dates(t.transactions)),
    "user_activity_by_date": _activity,
    "active_user_rate": marts.active_user_rate,
    "active_user_rate_expanded": lambda t: activity.active_user_rate_from_activity(_activity(t)),
    "active_user_rate_min_transactions": lambda t: marts.active_user_rate(t, min_transactions=1),
    "active_user_rate_as_of": marts.active_user_rate_as_of,
    "status_counts": lambda t: reporting.status_counts(marts.unified_accounts(t)),
}

CASES = {
    "plain": dict(seed=1),
    "shared ids": dict(seed=2, shared_ids=True),
    "hot": dict(seed=3, hot_share=0.4),
    "hot and shared": dict(seed=4, hot_share=0.4, shared_ids=True),
}


@pytest.fixture(scope="module", params=CASES)
def tables(request, spark):
    rows = drawn(**CASES[request.param])
    return spark_tables(spark, rows), duck_tables(rows)


@pytest.mark.parametrize("name", QUERIES)
def test_equals_the_sql_text(tables, name):
    t, connection = tables
    if name == "closures_gap_dedupe":
        connection.execute(
            "CREATE OR REPLACE VIEW with_ts AS SELECT * FROM account_closed WHERE closed_ts IS NOT NULL")
        sql = TEXTS[name].replace("FROM account_closed", "FROM with_ts")
    else:
        sql = TEXTS[name]
    expected, columns = duck_rows(connection, sql)
    got = QUERIES[name](t)
    assert sorted(got.columns) == columns
    assert expected and spark_rows(got) == expected


def test_rate_properties(tables):
    t, _ = tables
    for r in marts.active_user_rate(t).collect():
        assert 0 <= r.active_users <= r.total_open_users
        assert 0 <= r.seven_day_active_user_rate <= 1


def test_closure_dedupe_is_idempotent(tables):
    t, _ = tables
    once = latest_closure_per_day(t.closed)
    assert spark_rows(latest_closure_per_day(once)) == spark_rows(once)


def test_every_created_account_is_in_the_unified_table(tables):
    t, _ = tables
    unified = marts.unified_accounts(t).select("account_id_hashed").distinct()
    assert spark_rows(unified) == spark_rows(t.created.select("account_id_hashed").distinct())
