import datetime

import pytest
from pyspark.sql import functions as F

from build import spark_tables, ts, written
from tidemark import columns as c
from tidemark.operators import quality
from tidemark.plans import checks, marts
from tidemark.sources import contracts
from tidemark.sources.tables import conform_all, development_limit, read_database, read_folder

AS_OF = datetime.datetime(2024, 1, 5, 8)


@pytest.fixture(scope="module")
def damaged(spark):
    """Each declared source rule is broken a known number of times."""
    return spark_tables(spark, written(
        created=[("a", "u", None, "1 08:00"), ("a", "v", None, "1 08:00"),
                 ("b", None, None, "1 09:00"), (None, "w", "uk_retail", None)],
        closed=[("a", "5 00:00"), ("x", "4 09:00"), ("x", "4 10:00"), (None, None)],
        reopened=[("y", "5 00:01")],
        transactions=[("a", -1, "2"), ("a", 1, "2"), ("b", None, "3"), ("z", 1, None)],
    ))


@pytest.fixture(scope="module")
def sources(damaged):
    return {"account_created": damaged.created, "account_closed": damaged.closed,
            "account_reopened": damaged.reopened, "account_transactions": damaged.transactions}


EXPECTED = {
    "not_null_account_created_account_id_hashed": (1, "warn"),
    "unique_account_created_account_id_hashed": (1, "warn"),
    "not_null_account_created_user_id_hashed": (1, "warn"),
    "not_null_account_created_account_type": (3, "error"),
    "not_null_account_created_created_ts": (1, "error"),
    "not_null_account_reopened_account_id_hashed": (0, "pass"),
    "relationship_account_reopened_account_created": (1, "warn"),
    "not_null_account_reopened_reopened_ts": (0, "pass"),
    "not_null_account_closed_account_id_hashed": (1, "warn"),
    "relationship_account_closed_account_created": (2, "warn"),
    "not_null_account_closed_closed_ts": (1, "error"),
    "not_null_account_transactions_account_id_hashed": (0, "pass"),
    "unique_account_transactions_account_id_hashed": (1, "warn"),
    "unique_combination_account_transactions_account_id_hashed_date": (1, "warn"),
    "relationship_account_transactions_account_created": (1, "warn"),
    "expression_account_transactions_not_negative": (1, "warn"),
    "not_null_account_transactions_date": (1, "error"),
    "one_user_per_account": (1, "warn"),
    "freshness_account_created": (1, "warn"),
    "freshness_account_reopened": (0, "pass"),
    "freshness_account_closed": (0, "pass"),
    "freshness_account_transactions": (1, "warn"),
}


def test_source_suite_on_damaged_tables(sources):
    declared = checks.source_checks() + checks.freshness_checks()
    rows = checks.run_checks(sources, declared, as_of=AS_OF).collect()
    assert {r.check_name: (r.failures, r.status) for r in rows} == EXPECTED


def test_counts_gathered_while_writing_are_those_of_a_pass(spark, tmp_path, sources):
    declared = checks.source_checks() + checks.freshness_checks()
    watch = checks.Watch(declared)
    for name, df in sources.items():
        watch.over(name, df).write.parquet(f"{tmp_path}/{name}")
    # Tables that only row rules and freshness concern are not read again.
    unread = spark.range(0).select(F.raise_error(F.lit("read")).alias(c.REOPENED))
    alone = [r for r in declared if r.name in watch.seen()]
    assert len(alone) == 15
    rows = checks.run_checks({n: unread for n in sources}, alone, AS_OF, watch.seen()).collect()
    assert {r.check_name: (r.failures, r.status) for r in rows} == {
        r.name: EXPECTED[r.name] for r in alone}
    rows = checks.run_checks(sources, declared, AS_OF, watch.seen()).collect()
    assert {r.check_name: (r.failures, r.status) for r in rows} == EXPECTED


def test_a_watch_over_an_empty_table(spark, tmp_path):
    empty = spark_tables(spark, {}).closed
    rules = [checks.not_null("account_closed", c.CLOSED), checks.freshness_checks()[2]]
    watch = checks.Watch(rules)
    watch.over("account_closed", empty).write.parquet(f"{tmp_path}/t")
    rows = checks.run_checks({"account_closed": empty}, rules, AS_OF, watch.seen()).collect()
    assert {r.check_name: r.failures for r in rows} == {rules[0].name: 0, rules[1].name: 1}


def test_several_keys_of_a_table_are_judged_apart(spark):
    """NULLs are keys of a combination, none of a single column; agreement ignores them."""
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "x", 2), ("a", None, 1), ("b", "y", None), ("b", "y", 1),
         (None, "x", 1), (None, "x", 1), (None, None, 3), (None, None, 3)],
        "k string, v string, w int")
    rules = [checks.unique("t", "k"), checks.unique_combination("t", ["k", "v"]),
             checks.unique_combination("t", ["v", "w"]), checks.accepted_values("t", "v", ["x"]),
             checks.KeyCheck("agree_w", "t", ("k",), several="w"),
             checks.KeyCheck("agree_v", "t", ("k",), several="v"),
             checks.KeyCheck("three", "t", ("v",), F.col("w") == 1, most=2)]
    rows = checks.run_checks({"t": df}, rules).collect()
    got = {r.check_name: r.failures for r in rows}
    assert got == {"unique_t_k": 2, "unique_combination_t_k_v": 4, "unique_combination_t_v_w": 2,
                   "accepted_values_t_v": 1, "agree_w": 2, "agree_v": 0, "three": 1}
    for rule in rules:
        assert checks.failing_rows({"t": df}, rule).count() == got[rule.name], rule.name


def test_orphans_of_several_children(spark, damaged):
    children = {"closed": damaged.closed, "again": damaged.closed, "reopened": damaged.reopened}
    got = {tuple(r) for r in quality.orphaned_keys_of(children, damaged.created).collect()}
    assert got == {("closed", "x", 2), ("again", "x", 2), ("reopened", "y", 1)}
    assert [tuple(r) for r in quality.orphaned_keys(damaged.closed, damaged.created).collect()] \
        == [("x", 2)]


def test_nulls_up_to_the_threshold_warn(spark):
    two = spark_tables(spark, written(created=[("a", "u", None, "1"), ("b", "u", None, "1")]))
    rule = checks.not_null("account_created", c.ACCOUNT_TYPE, error_above=2)
    row = checks.run_checks({"account_created": two.created}, [rule]).first()
    assert (row.failures, row.status) == (2, "warn")


def test_suite_on_an_empty_table(spark):
    empty = spark_tables(spark, {})
    tables = {"account_created": empty.created, "account_closed": empty.closed,
              "account_reopened": empty.reopened, "account_transactions": empty.transactions}
    declared = checks.source_checks() + checks.freshness_checks()
    rows = checks.run_checks(tables, declared, as_of=AS_OF).collect()
    assert {r.check_name for r in rows if r.failures} == {
        r.name for r in checks.freshness_checks()}


def test_freshness_boundary(spark):
    t = spark_tables(spark, written(closed=[("a", "5 00:00")]))
    exact = quality.freshness(t.closed, c.CLOSED, AS_OF).first()
    assert (exact.age_seconds, exact.is_stale) == (8 * 3600, False)
    later = quality.freshness(t.closed, c.CLOSED, AS_OF + datetime.timedelta(seconds=1)).first()
    assert later.is_stale
    with pytest.raises(ValueError):
        checks.run_checks({"account_closed": t.closed}, checks.freshness_checks()[2:3])


def test_failing_rows_are_stored_and_cleared(spark, tmp_path, sources):
    rules = [checks.not_null("account_created", c.USER), checks.unique("account_created", c.ACCOUNT)]
    stored = checks.store_failures(spark, sources, rules, str(tmp_path))
    assert [r.account_id_hashed for r in stored[rules[0].name].collect()] == ["b"]
    assert [tuple(r) for r in stored[rules[1].name].collect()] == [("a", 2)]
    sound = {"account_created": sources["account_created"].filter(F.col(c.ACCOUNT) == "none")}
    stored = checks.store_failures(spark, sound, rules, str(tmp_path))
    assert [stored[r.name].count() for r in rules] == [0, 0]


def test_row_checks_of_a_table_are_stored_in_one_pass(spark, tmp_path, sources):
    rules = [r for r in checks.source_checks() if r.table == "account_created"]
    stored = checks.store_failures(spark, sources, rules, str(tmp_path))
    assert {n: df.count() for n, df in stored.items()} == {
        r.name: EXPECTED[r.name][0] for r in rules}
    written_tables = {p.name for p in tmp_path.iterdir()}
    assert written_tables == {"rows_of_account_created"} | {
        r.name for r in rules if not isinstance(r, checks.RowCheck)}


def test_column_report(sources):
    lacking = sources | {"account_created": sources["account_created"].drop(c.USER)}
    report = {(r.table_name, r.column_name): (r.present, r.n_values)
              for r in checks.column_report(lacking).collect()}
    assert report["account_created", c.USER] == (False, 0)
    assert report["account_created", c.ACCOUNT] == (True, 3)
    assert report["account_transactions", c.TX_DATE] == (True, 3)


def test_mart_checks_on_damaged_marts(spark):
    t = spark_tables(spark, written(
        created=[("a", "u", "uk_retail", "3 08:00"), ("b", "u", "uk_retail", "1")],
        closed=[("a", "2 08:00")], transactions=[("b", 2, "1")]))
    unified = marts.unified_accounts(t)
    assert [r.closed_ts for r in quality.lifecycle_order_violations(unified).collect()] == [
        ts("2 08:00")]
    assert quality.total_mismatches(unified, t.transactions).count() == 0
    wrong = unified.withColumn(c.TOTAL, F.lit(5).cast("bigint")).unionByName(unified)
    got = {(r.account_id_hashed, r.total_transactions, r.expected_total)
           for r in quality.total_mismatches(wrong, t.transactions).collect()}
    assert got == {("a", 5, 0), ("b", 5, 2)}
    odd = unified.withColumn(c.STATUS, F.lit("frozen"))
    assert [tuple(r) for r in quality.unaccepted_values(
        odd, c.STATUS, checks.ACCOUNT_STATES).collect()] == [("frozen", 2)]
    tables = {"deduplicated_closures": t.closed, "unified_accounts": unified,
              "active_user_rate": marts.active_user_rate(t),
              "account_transactions": t.transactions}
    failing = {r.check_name: r.failures
               for r in checks.run_checks(tables, checks.mart_checks()).collect() if r.failures}
    assert failing == {"lifecycle_order": 1, "not_null_unified_accounts_closed_ts": 1,
                       "not_null_unified_accounts_reopened_ts": 2}


def test_missing_columns(sources):
    assert all(not v for v in checks.missing_columns(sources).values())
    lacking = sources | {"account_created": sources["account_created"].drop(c.USER)}
    assert checks.missing_columns(lacking)["account_created"] == [c.USER]


def test_conform_casts_drops_and_refuses(spark, damaged):
    wide = spark.sql("SELECT 7 AS account_id_hashed, 'x' AS other, "
                     "TIMESTAMP '2024-01-01 10:00:00' AS closed_ts")
    conformed = contracts.conform(wide, contracts.ACCOUNT_CLOSED)
    assert conformed.schema == contracts.ACCOUNT_CLOSED or conformed.columns == [c.ACCOUNT, c.CLOSED]
    assert tuple(conformed.first()) == ("7", datetime.datetime(2024, 1, 1, 10))
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    try:
        with pytest.raises(contracts.SchemaMismatch, match="timeZone"):
            contracts.conform(wide, contracts.ACCOUNT_CLOSED)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_reading_folders_and_databases(spark, tmp_path, damaged):
    names = ["account_created", "account_closed", "account_reopened", "account_transactions"]
    spark.sql("CREATE DATABASE IF NOT EXISTS bank")
    frames = [damaged.created, damaged.closed, damaged.reopened, damaged.transactions]
    for name, df in zip(names, frames):
        df.write.parquet(f"{tmp_path}/{name}")
        df.write.mode("overwrite").saveAsTable(f"bank.{name}")
    for t in (read_folder(spark, str(tmp_path)), read_database(spark, "bank")):
        assert (t.created.count(), t.closed.count(), t.reopened.count(),
                t.transactions.count()) == (4, 4, 1, 4)
    spark.sql("DROP DATABASE bank CASCADE")
    assert conform_all(*frames).created.columns == contracts.ACCOUNT_CREATED.fieldNames()


def test_development_limit(damaged):
    assert development_limit(damaged.closed, True, 2).count() == 2
    assert development_limit(damaged.closed, False, 2).count() == 4


def test_scratch_folder_comes_from_the_session():
    from tidemark.session import scratch_root

    class Session:
        def __init__(self, folder, context_folder=None):
            self.sparkContext = type("Context", (), {
                "getCheckpointDir": lambda _: context_folder})()
            self.conf = {"spark.checkpoint.dir": folder}

    assert scratch_root(Session("hdfs:///shared/")) == "hdfs:///shared"
    assert scratch_root(Session(None, "hdfs:///other")) == "hdfs:///other"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session(None))
