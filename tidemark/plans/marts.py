"""The two marts, composed from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import activity, lifecycle
from tidemark.operators.closures import deduplicate_closures, latest_closure_per_day
from tidemark.plans import stored
from tidemark.plans.checks import Watch
from tidemark.sources import contracts
from tidemark.sources.tables import AccountTables


def status_rows(t: AccountTables, mode: str = "day", states: int = 3) -> DataFrame:
    closures = deduplicate_closures(t.closed, mode)
    return lifecycle.account_status(
        lifecycle.closure_reopen_pairs(t.created, closures, t.reopened), states)


def unified_accounts(t: AccountTables, mode: str = "day") -> DataFrame:
    return lifecycle.unified_accounts(t.created, t.closed, t.reopened, t.transactions, mode)


def open_spans(t: AccountTables) -> DataFrame:
    """The spans of the status rows that read open or reopened."""
    return activity.open_spans_from_events(
        t.created, latest_closure_per_day(t.closed), t.reopened)


def active_user_rate(t: AccountTables, window_days: int = 7,
                     min_transactions: int | None = None) -> DataFrame:
    intervals = activity.open_intervals(open_spans(t))
    return activity.active_user_rate(intervals, t.transactions, window_days, min_transactions)


def active_user_rate_as_of(t: AccountTables, window_days: int = 7) -> DataFrame:
    spans = activity.spans_as_of(t.created, t.closed, t.reopened)
    return activity.active_user_rate_of_spans(spans, t.transactions, window_days)


def create_base_views(t: AccountTables) -> None:
    """The conformed inputs as views for SQL users."""
    t.created.createOrReplaceTempView("base_account_created")
    t.closed.createOrReplaceTempView("base_account_closed")
    t.reopened.createOrReplaceTempView("base_account_reopened")
    t.transactions.createOrReplaceTempView("base_account_transactions")


def build_marts(spark: SparkSession, t: AccountTables, database: str,
                watch: Watch | None = None) -> dict[str, DataFrame]:
    """Write closures, unified accounts and the rate; each later table reads written ones.

    A watch gathers the counts of its checks on the way.
    """
    def written(name: str, df: DataFrame) -> DataFrame:
        return _written(spark, f"{database}.{name}", df, watch)

    closures = written("deduplicated_closures", latest_closure_per_day(t.closed))
    deduplicated = AccountTables(t.created, closures, t.reopened, t.transactions)
    unified = written("unified_accounts", contracts.conform(
        unified_accounts(deduplicated), contracts.UNIFIED_ACCOUNTS))
    intervals = activity.open_intervals(activity.open_spans(unified))
    rate = written("active_user_rate", contracts.conform(
        activity.active_user_rate(intervals, t.transactions), contracts.ACTIVE_USER_RATE))
    return {"deduplicated_closures": closures, "unified_accounts": unified,
            "active_user_rate": rate}


def _written(spark: SparkSession, table: str, df: DataFrame, watch: Watch | None) -> DataFrame:
    stored.replace(watch.over(table.split(".")[-1], df) if watch else df, table)
    return spark.table(table)


def store_sources(spark: SparkSession, t: AccountTables, database: str,
                  watch: Watch | None = None) -> AccountTables:
    """The conformed sources as tables of their own: derived once, however often they are read."""
    names = ("account_created", "account_closed", "account_reopened", "account_transactions")
    return AccountTables(*(
        _written(spark, f"{database}.{name}", df, watch)
        for name, df in zip(names, (t.created, t.closed, t.reopened, t.transactions))))
