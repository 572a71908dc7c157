"""The registered queries: every operator over the whole `events` table of a folder."""

from __future__ import annotations

import datetime
import functools
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.scratch import with_scratch
from tidemark import columns as c
from tidemark.columns import ACCOUNT, USER
from tidemark.functions.time import moment
from tidemark.operators import activity, closures, incremental, lifecycle, quality, reporting
from tidemark.plans import checks, kept_rate, loads, marts
from tidemark.session import new_scratch_database, new_scratch_path
from tidemark.sources import contracts
from tidemark.sources.events import read_account_tables
from tidemark.sources.tables import AccountTables, development_limit
from tidemark.streaming.arrivals import load_on_arrival

Query = Callable[[SparkSession, str], DataFrame]

RUN_AT = datetime.datetime(2024, 1, 31, 6)
LIMITED_ROWS = 100
#: Parts of the marts, and of a day in the base tables: few, since the tables here are small.
SMALL_MART_BUCKETS, BASE_BUCKETS = 8, 2
FIRST_RUN_END = datetime.datetime(2024, 1, 20)
NULLABLE = {
    "account_created": contracts.ACCOUNT_CREATED.fieldNames(),
    "account_closed": contracts.ACCOUNT_CLOSED.fieldNames(),
    "account_reopened": contracts.ACCOUNT_REOPENED.fieldNames(),
    "account_transactions": [ACCOUNT, c.TX_DATE],
    "unified": [ACCOUNT, USER, c.ACCOUNT_TYPE, c.CREATED, c.CLOSED, c.REOPENED, c.STATUS],
    "rate": contracts.ACTIVE_USER_RATE.fieldNames(),
}
LOADED_AT = {"account_created": c.CREATED, "account_reopened": c.REOPENED,
             "account_closed": c.CLOSED, "account_transactions": c.TX_DATE}


def _over_tables(query: Callable[[AccountTables], DataFrame]) -> Query:
    return lambda spark, folder: query(read_account_tables(spark, folder))


def _union(parts) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def _by_name(t: AccountTables) -> dict[str, DataFrame]:
    return {"account_created": t.created, "account_closed": t.closed,
            "account_reopened": t.reopened, "account_transactions": t.transactions}


def _pairs(t: AccountTables) -> DataFrame:
    return lifecycle.closure_reopen_pairs(
        t.created, closures.latest_closure_per_day(t.closed), t.reopened)


def _activity(t: AccountTables) -> DataFrame:
    return activity.user_activity_by_date(marts.open_spans(t), t.transactions)


def _damaged(t: AccountTables) -> AccountTables:
    """Some created rows without account id, others without user: no row is dropped.

    The events of the former become orphans, so that checks and marts have both to deal with.
    """
    def lost(column: str, digit: str):
        return F.when(~F.col(ACCOUNT).endswith(digit), F.col(column)).alias(column)

    created = t.created.select(
        lost(ACCOUNT, "7"), lost(USER, "3"), c.ACCOUNT_TYPE, c.CREATED)
    return AccountTables(created, t.closed, t.reopened, t.transactions)


def _development_limit(t: AccountTables) -> DataFrame:
    return _union(
        development_limit(t.transactions, enabled, rows=LIMITED_ROWS)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(enabled).alias("limited"), "row_count")
        for enabled in (True, False))


def _first_run(t: AccountTables) -> AccountTables:
    """What had happened when the first of two runs took place."""
    def before(df: DataFrame, ts: str) -> DataFrame:
        return df.filter(F.col(ts) < moment(FIRST_RUN_END))

    return AccountTables(before(t.created, c.CREATED), before(t.closed, c.CLOSED),
                         before(t.reopened, c.REOPENED), before(t.transactions, c.TX_DATE))


def _base_state(name: str) -> Query:
    """A full load of what the first run saw, then a look-back load of everything.

    Besides what had not happened yet, the first run misses late rows: events of the last two
    hours of a day, and for the daily table days with several transactions.
    """
    def query(spark: SparkSession, folder: str) -> DataFrame:
        source = _by_name(read_account_tables(spark, folder))[name]
        contract, key = loads.BASE_TABLES[name]
        in_time = (F.col(c.TX_COUNT) < 2 if name == "account_transactions"
                   else F.hour(key) < 22)
        seen = source.filter(
            (F.col(key) < moment(FIRST_RUN_END)) & in_time)
        table = f"{new_scratch_database(spark)}.{name}"
        loads.load_base(spark, seen, table, contract, key)
        loads.load_base(spark, source, table, contract, key)
        return loads.read_base(spark, table, contract)

    return query


def _changed_rows(t: AccountTables) -> DataFrame:
    target = marts.unified_accounts(_first_run(t))
    return incremental.changed_rows(marts.unified_accounts(t), target)


def _mart_literal(spark: SparkSession, folder: str, null_safe: bool = False) -> DataFrame:
    t = _damaged(read_account_tables(spark, folder))
    table = f"{new_scratch_database(spark)}.unified_accounts"
    loads.load_mart(spark, marts.unified_accounts(_first_run(t)), table, null_safe,
                    SMALL_MART_BUCKETS)
    return loads.load_mart(spark, marts.unified_accounts(t), table, null_safe)


def _in_time(t: AccountTables) -> AccountTables:
    """What the first run saw: nothing later than its end, and no row of a day's last hours."""
    seen = _first_run(t)

    def before_ten(df: DataFrame, ts: str) -> DataFrame:
        return df.filter(F.hour(ts) < 22)

    return AccountTables(before_ten(seen.created, c.CREATED), before_ten(seen.closed, c.CLOSED),
                         before_ten(seen.reopened, c.REOPENED), seen.transactions)


def _mart_rebuild(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without account id, and late rows that the second run's look-back misses."""
    t = _damaged(read_account_tables(spark, folder))
    seen = _in_time(t)
    table = f"{new_scratch_database(spark)}.unified_accounts"
    loads.rebuild_touched(spark, seen, incremental.touched_accounts(seen.created), table,
                          SMALL_MART_BUCKETS)
    runs = [(t.created, seen.created, c.CREATED), (t.closed, seen.closed, c.CLOSED),
            (t.reopened, seen.reopened, c.REOPENED),
            (t.transactions, seen.transactions, c.TX_DATE)]
    starts = incremental.look_back_starts([(before, key) for _, before, key in runs])
    batches = [incremental.since(now, key, start)
               for (now, _, key), start in zip(runs, starts)]
    return loads.rebuild_touched(spark, t, incremental.touched_accounts(*batches), table)


def _both_runs(spark: SparkSession, folder: str) -> Iterator[tuple[str, DataFrame | None]]:
    """The base tables after each of two loads, and the accounts the load touched."""
    t = _damaged(read_account_tables(spark, folder))
    database = new_scratch_database(spark)
    for tables in (_in_time(t), t):
        yield database, loads.load_bases(spark, tables, database, BASE_BUCKETS)


def _mart_from_bases(spark: SparkSession, folder: str) -> DataFrame:
    for database, touched in _both_runs(spark, folder):
        mart = loads.rebuild_from_bases(spark, database, touched, f"{database}.unified_accounts")
    return mart


def _late_closures(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Closures that arrive in two drops, the second with late rows; the table, and those rows."""
    closed = read_account_tables(spark, folder).closed
    contract, key = loads.BASE_TABLES["account_closed"]
    in_time = (F.col(key) < moment(FIRST_RUN_END)) & (F.hour(key) < 22)
    source, database = new_scratch_path(spark, "source"), new_scratch_database(spark)
    checkpoint = new_scratch_path(spark, "arrivals")
    for drop in (in_time, ~in_time):
        closed.filter(drop).write.mode("append").parquet(source)
        load_on_arrival(spark, source, contract, f"{database}.closed", contract, key, checkpoint,
                        late_table=f"{database}.late").awaitTermination()
    return (loads.read_base(spark, f"{database}.closed", contract),
            spark.table(f"{database}.late").drop("arrival"))


def _rate_from_bases(spark: SparkSession, folder: str) -> DataFrame:
    for database, touched in _both_runs(spark, folder):
        rate = kept_rate.load_rate(spark, database, touched, buckets=SMALL_MART_BUCKETS)
    return rate


def _mart_by_content(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The mart after two runs compared by content, and what the second one changed."""
    t = _damaged(read_account_tables(spark, folder))
    table = f"{new_scratch_database(spark)}.unified_accounts"
    loads.load_by_content(spark, marts.unified_accounts(_first_run(t)), table, SMALL_MART_BUCKETS)
    return loads.load_by_content(spark, marts.unified_accounts(t), table)


def _base_views(spark: SparkSession, folder: str) -> DataFrame:
    """What SQL over the views of the conformed sources finds."""
    marts.create_base_views(read_account_tables(spark, folder))
    return spark.sql("""
        SELECT a.account_type, count(DISTINCT a.account_id_hashed) AS accounts,
               count(DISTINCT c.account_id_hashed) AS closed_accounts,
               count(DISTINCT r.account_id_hashed) AS reopened_accounts,
               coalesce(max(t.transactions_num), 0) AS busiest_day
        FROM base_account_created a
        LEFT JOIN (SELECT DISTINCT account_id_hashed FROM base_account_closed) c
               ON c.account_id_hashed = a.account_id_hashed
        LEFT JOIN (SELECT DISTINCT account_id_hashed FROM base_account_reopened) r
               ON r.account_id_hashed = a.account_id_hashed
        LEFT JOIN (SELECT account_id_hashed, max(transactions_num) AS transactions_num
                   FROM base_account_transactions GROUP BY account_id_hashed) t
               ON t.account_id_hashed = a.account_id_hashed
        GROUP BY a.account_type""")


def _built(spark: SparkSession, t: AccountTables,
           watch: checks.Watch | None = None) -> dict[str, DataFrame]:
    """The sources and the marts as written tables."""
    database = new_scratch_database(spark)
    t = marts.store_sources(spark, t, database, watch)
    return _by_name(t) | marts.build_marts(spark, t, database, watch)


def _built_mart(name: str) -> Query:
    return lambda spark, folder: _built(spark, read_account_tables(spark, folder))[name]


def _schema_guard(spark: SparkSession, folder: str) -> DataFrame:
    """A load whose source lacks a column is refused and leaves the table as it was."""
    source = read_account_tables(spark, folder).closed
    contract, key = loads.BASE_TABLES["account_closed"]
    table = f"{new_scratch_database(spark)}.account_closed"
    loads.load_base(spark, source, table, contract, key)
    refused = False
    try:
        loads.load_base(spark, source.drop(key), table, contract, key)
    except contracts.SchemaMismatch:
        refused = True
    return loads.read_base(spark, table, contract).withColumn("refused", F.lit(refused))


def _column_comments(spark: SparkSession, folder: str) -> DataFrame:
    """The comments a written mart keeps, and how many values each column has."""
    mart = _built(spark, read_account_tables(spark, folder))["active_user_rate"]
    counts = mart.agg(*[F.count(n).alias(n) for n in mart.columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"),
                 F.lit(f.metadata.get("comment")).alias("comment"), F.col(f.name).alias("n_values"))
        for f in mart.schema.fields])))


def _check_not_null(spark: SparkSession, folder: str) -> DataFrame:
    tables = _built(spark, _damaged(read_account_tables(spark, folder)))
    tables |= {"unified": tables["unified_accounts"], "rate": tables["active_user_rate"]}
    return _union(
        quality.null_counts(tables[name], columns)
        .select(F.lit(name).alias("table_name"), "column_name", quality.FAILURES)
        for name, columns in NULLABLE.items())


def _check_relationships(t: AccountTables) -> DataFrame:
    tables = _by_name(t)
    children = {n: tables[n] for n in ("account_closed", "account_reopened",
                                       "account_transactions")}
    return quality.orphaned_keys_of(children, t.created).withColumnRenamed("child", "table_name")


def _check_freshness(t: AccountTables) -> DataFrame:
    tables = _by_name(t)
    return _union(
        quality.freshness(tables[name], ts, RUN_AT)
        .select(F.lit(name).alias("table_name"), "latest_ts", "age_seconds", "is_stale")
        for name, ts in LOADED_AT.items())


def _check_one_user(t: AccountTables) -> DataFrame:
    """Accounts with several users, and the allowed converse for contrast."""
    def several(key: str, value: str) -> DataFrame:
        return quality.keys_with_several(t.created, key, value).agg(
            F.count(F.lit(1)).alias("keys_with_several")
        ).select(F.lit(key).alias("key_column"), "keys_with_several")

    return several(ACCOUNT, USER).unionByName(several(USER, ACCOUNT))


def _check_summary(spark: SparkSession, folder: str) -> DataFrame:
    declared = checks.source_checks() + checks.freshness_checks() + checks.mart_checks()
    watch = checks.Watch(declared)
    tables = _built(spark, _damaged(read_account_tables(spark, folder)), watch)
    return checks.run_checks(tables, declared, as_of=RUN_AT, seen=watch.seen())


def _stored_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Failing rows of all row and table checks, stored as tables and counted from there."""
    tables = _built(spark, _damaged(read_account_tables(spark, folder)))
    declared = checks.source_checks() + checks.mart_checks()
    stored = checks.store_failures(spark, tables, declared, new_scratch_path(spark, "failures"))
    return _union(
        df.agg(F.count(F.lit(1)).alias("stored_rows"))
        .select(F.lit(name).alias("check_name"), "stored_rows")
        for name, df in stored.items())


def _check_columns(t: AccountTables) -> DataFrame:
    """The declared columns, with one taken away from the created table."""
    return checks.column_report(_by_name(t) | {"account_created": t.created.drop(USER)})


def all_queries() -> dict[str, Query]:
    return {name: with_scratch(query) for name, query in _queries().items()}


def _queries() -> dict[str, Query]:
    q = _over_tables
    return {
        "typed_accounts": q(lambda t: t.created),
        "typed_closures": q(lambda t: t.closed),
        "typed_reopens": q(lambda t: t.reopened),
        "typed_transactions": q(lambda t: t.transactions),
        "development_limit": q(_development_limit),
        "closures_latest_per_day": q(lambda t: closures.latest_closure_per_day(t.closed)),
        "closures_gap_dedupe": q(lambda t: closures.closures_without_close_successor(t.closed)),
        "closure_reopen_pairs": q(_pairs),
        "account_status_rows": q(lambda t: marts.status_rows(t)),
        "account_status_two_state": q(lambda t: marts.status_rows(t, states=2)),
        "multiple_closures_without_reopen": q(lambda t: lifecycle.multiple_closures(_pairs(t))),
        "consecutive_closures": q(lambda t: lifecycle.consecutive_closures(_pairs(t))),
        "transaction_totals": q(lambda t: lifecycle.transaction_totals(t.transactions)),
        "unified_accounts": q(marts.unified_accounts),
        "unified_accounts_without_id": q(lambda t: marts.unified_accounts(_damaged(t))),
        "unified_accounts_gap": q(lambda t: marts.unified_accounts(t, mode="gap")),
        "calculation_dates": q(lambda t: activity.calculation_dates(t.transactions)),
        "open_accounts_by_date": q(lambda t: activity.open_accounts_by_date(
            marts.open_spans(t), activity.calculation_dates(t.transactions))),
        "user_activity_by_date": q(_activity),
        "active_user_rate": q(marts.active_user_rate),
        "active_user_rate_expanded": q(
            lambda t: activity.active_user_rate_from_activity(_activity(t))),
        "active_user_rate_min_transactions": q(
            lambda t: marts.active_user_rate(t, min_transactions=1)),
        "active_user_rate_as_of": q(marts.active_user_rate_as_of),
        # Looking up one user is the operator; it reads the whole tables like the others.
        "user_drilldown": q(lambda t: activity.user_drilldown(_activity(t), "user-1")),
        "user_drilldown_on_date": q(lambda t: activity.user_drilldown(
            _activity(t), "user-1", datetime.date(2024, 1, 20))),
        "current_account_status_without_id": q(lambda t: lifecycle.current_account_status(
            marts.unified_accounts(_damaged(t)))),
        "current_account_status": q(
            lambda t: lifecycle.current_account_status(marts.unified_accounts(t))),
        "status_counts": q(lambda t: reporting.status_counts(marts.unified_accounts(t))),
        "transactions_by_type_status": q(lambda t: reporting.transactions_by_type_and_status(
            lifecycle.current_account_status(marts.unified_accounts(t)))),
        "anomalous_accounts": q(lambda t: lifecycle.anomalous_accounts(_pairs(t))),
        "lifecycle_by_week": q(lambda t: reporting.lifecycle_by_period(
            t.created, t.closed, t.reopened, period="week")),
        "lifecycle_by_month": q(lambda t: reporting.lifecycle_by_period(
            t.created, t.closed, t.reopened, period="month")),
        "cohort_retention_by_week": q(lambda t: reporting.cohort_retention(
            lifecycle.current_account_status(marts.unified_accounts(t)), period="week")),
        "account_transactions_over_time": q(
            lambda t: reporting.account_transactions_over_time(t.transactions)),
        "changed_rows": q(_changed_rows),
        "incremental_accounts_state": _base_state("account_created"),
        "incremental_closures_state": _base_state("account_closed"),
        "incremental_reopens_state": _base_state("account_reopened"),
        "incremental_transactions_state": _base_state("account_transactions"),
        "incremental_mart_literal": _mart_literal,
        "incremental_mart_null_safe": lambda spark, folder: _mart_literal(spark, folder, True),
        "incremental_mart_rebuild": _mart_rebuild,
        "incremental_mart_from_bases": _mart_from_bases,
        "incremental_rate": _rate_from_bases,
        "incremental_mart_by_content": lambda spark, folder: _mart_by_content(spark, folder)[0],
        "mart_content_changes": lambda spark, folder: _mart_by_content(spark, folder)[1],
        "base_views": _base_views,
        "arrivals_closures_state": lambda spark, folder: _late_closures(spark, folder)[0],
        "arrivals_late_closures": lambda spark, folder: _late_closures(spark, folder)[1],
        "schema_guard": _schema_guard,
        "mart_unified_accounts": _built_mart("unified_accounts"),
        "mart_active_user_rate": _built_mart("active_user_rate"),
        "mart_column_comments": _column_comments,
        "check_columns_exist": q(_check_columns),
        "check_not_null": _check_not_null,
        "check_unique": q(lambda t: quality.duplicated_keys(
            t.transactions, [ACCOUNT], ignore_nulls=True)),
        "check_unique_combination": q(lambda t: quality.duplicated_keys(
            marts.unified_accounts(t), [ACCOUNT, c.REOPENED])),
        # The accepted lists and bounds here are tighter than declared, to have failures.
        "check_accepted_values": q(lambda t: quality.unaccepted_values(
            marts.unified_accounts(t), c.ACCOUNT_TYPE, ["uk_retail", "uk_retail_pot"])),
        "check_relationships": q(lambda t: _check_relationships(_damaged(t))),
        "check_expression": q(lambda t: quality.violating_rows(
            marts.unified_accounts(_damaged(t)), F.col(c.TOTAL) >= 1)),
        "check_freshness": q(_check_freshness),
        "check_lifecycle_order": q(
            lambda t: quality.lifecycle_order_violations(marts.unified_accounts(t))),
        # A mart left at the first run, against the transactions of today.
        "check_totals": q(lambda t: quality.total_mismatches(
            marts.unified_accounts(_first_run(t)), t.transactions)),
        "check_one_user_per_account": q(_check_one_user),
        "check_stored_failures": _stored_failures,
        "check_summary": _check_summary,
    }
