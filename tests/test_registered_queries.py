import pytest

import __spark_entry__ as entry_module
from registry import oracle
from registry.queries import all_queries
from compare import duck, duck_rows, spark_rows

QUERIES = all_queries()
TEXTS = oracle.texts()


def test_every_query_has_a_text():
    assert QUERIES.keys() == TEXTS.keys()
    assert QUERIES.keys() <= entry_module.queries().keys()
    assert TEXTS.keys() <= entry_module.oracle_sql().keys()


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_equals_the_sql_text(spark, small, name):
    df = QUERIES[name](spark, small)
    expected, columns = duck_rows(duck(small), TEXTS[name])
    assert sorted(df.columns) == columns
    assert expected, "an empty answer shows nothing"
    assert spark_rows(df) == expected


@pytest.mark.parametrize("name", [
    "closures_gap_dedupe", "unified_accounts", "user_activity_by_date", "active_user_rate_as_of",
    "lifecycle_by_week", "incremental_closures_state", "check_freshness"])
def test_does_not_depend_on_the_session_zone(spark, smallest, name):
    expected, _ = duck_rows(duck(smallest), TEXTS[name])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert spark_rows(QUERIES[name](spark, smallest)) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
