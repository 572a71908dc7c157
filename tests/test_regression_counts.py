"""The measured counts of FIXTURES.md section 4."""

import pytest
from pyspark.sql import functions as F

from survey_tables import survey_tables
from tidemark.operators import activity, lifecycle, quality
from tidemark.operators.closures import closures_without_close_successor, latest_closure_per_day
from tidemark.plans import marts

COUNTS = {
    # created, closed, reopened, transactions, deduplicated, unified
    "sf0.001": (14, 59, 42, 54, 50, 53),
    "sf0.01": (139, 678, 406, 432, 586, 584),
    "sf0.1": (1385, 6938, 3941, 4676, 6089, 5989),
}
STATUS = {
    "sf0.001": {"closed": (10, 5), "open": (3, 3), "reopened": (40, 9)},
    "sf0.01": {"closed": (222, 76), "open": (35, 35), "reopened": (327, 82)},
    "sf0.1": {"closed": (2287, 755), "open": (349, 349), "reopened": (3353, 797)},
}
FLAGGED = {"sf0.001": (26, 5), "sf0.01": (426, 75), "sf0.1": (4248, 748)}
NULLS = {"sf0.001": (3, 13), "sf0.01": (35, 257), "sf0.1": (349, 2636)}
SUMS = {"sf0.001": (111, 32), "sf0.01": (819, 216), "sf0.1": (10214, 2498)}
RATE_ROWS = {"sf0.001": 25, "sf0.01": 30, "sf0.1": 30}
AS_OF = {"sf0.001": (84, 107), "sf0.01": (846, 1124), "sf0.1": (7919, 11001)}


@pytest.fixture(scope="module", params=COUNTS)
def scale(request, spark):
    tables = survey_tables(spark, f"/root/testdata/{request.param}")
    unified = marts.unified_accounts(tables).cache()
    yield request.param, tables, unified
    unified.unpersist()


def test_row_counts(scale):
    name, t, unified = scale
    got = (t.created.count(), t.closed.count(), t.reopened.count(), t.transactions.count(),
           latest_closure_per_day(t.closed).count(), unified.count())
    assert got == COUNTS[name]


def test_status_flags_and_totals(scale):
    name, t, unified = scale
    by_status = unified.groupBy("account_status").agg(
        F.count("*"), F.count_distinct("account_id_hashed")).collect()
    assert {r[0]: (r[1], r[2]) for r in by_status} == STATUS[name]
    flagged = unified.filter("multiple_closures_without_reopen_flag = 1")
    assert (flagged.count(), flagged.select("account_id_hashed").distinct().count()) == FLAGGED[name]
    nulls = {r[0]: r[1] for r in quality.null_counts(unified, ["closed_ts", "reopened_ts"]).collect()}
    assert (nulls["closed_ts"], nulls["reopened_ts"]) == NULLS[name]
    assert (unified.agg(F.sum("total_transactions")).first()[0],
            t.transactions.agg(F.sum("transactions_num")).first()[0]) == SUMS[name]
    assert quality.lifecycle_order_violations(unified).count() == 0


def test_rates(scale):
    name, t, _ = scale
    rate = marts.active_user_rate(t).collect()
    assert len(rate) == RATE_ROWS[name]
    as_of = marts.active_user_rate_as_of(t).agg(
        F.sum("active_users"), F.sum("total_open_users")).first()
    assert tuple(as_of) == AS_OF[name]


def test_more_at_the_middle_scale(spark, small):
    t = survey_tables(spark, small)
    assert closures_without_close_successor(t.closed).count() == 672
    rows = {str(r[0]): tuple(r[1:3]) for r in marts.active_user_rate(t).collect()}
    assert rows["2024-01-01"] == (1, 8)
    assert rows["2024-01-16"] == (34, 50)
    assert rows["2024-01-30"] == (26, 35)
    current = lifecycle.current_account_status(marts.unified_accounts(t))
    counts = {r[0]: r[1] for r in current.groupBy("account_status").count().collect()}
    assert counts == {"closed": 76, "open": 35, "reopened": 28}
    users = activity.user_activity_by_date(marts.open_spans(t), t.transactions)
    assert users.count() == 1079
    assert quality.duplicated_keys(t.transactions, ["account_id_hashed"]).count() == 120
    orphans = {n: quality.orphaned_keys(df, t.created).agg(F.sum("row_count")).first()[0]
               for n, df in (("closed", t.closed), ("reopened", t.reopened), ("tx", t.transactions))}
    assert orphans == {"closed": 45, "reopened": 28, "tx": 37}
