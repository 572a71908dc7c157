"""Ready-made reports over the unified table and its inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark import columns as c
from tidemark.columns import ACCOUNT, ACCOUNT_TYPE, STATUS
from tidemark.functions.time import day_of

PERIODS = ("week", "month", "quarter", "year")


def _period_start(ts: str, period: str):
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}")
    return F.trunc(day_of(ts), period)


def status_counts(unified: DataFrame) -> DataFrame:
    """Rows and accounts by status, type and creation day."""
    return (
        unified.groupBy(STATUS, ACCOUNT_TYPE, day_of(c.CREATED).alias("created_date"))
        .agg(F.count(F.lit(1)).alias("closure_rows"),
             F.count_distinct(ACCOUNT).alias("accounts"))
    )


def transactions_by_type_and_status(current: DataFrame) -> DataFrame:
    """Accounts and transaction volume by type and status, from the one-row-per-account table.

    The per-closure table repeats an account's total on each row and would over-count.
    """
    return (
        current.groupBy(ACCOUNT_TYPE, STATUS)
        .agg(F.count(F.lit(1)).alias("accounts"), F.sum(c.TOTAL).alias(c.TOTAL))
    )


def lifecycle_by_period(created: DataFrame, closed: DataFrame, reopened: DataFrame,
                        period: str = "month") -> DataFrame:
    """Accounts created, churned (closed) and reactivated (reopened) per period.

    An account counts once per period and kind, so repeated events need no other care.
    """
    def kind(df: DataFrame, ts: str, name: str) -> DataFrame:
        return df.filter(F.col(ts).isNotNull() & F.col(ACCOUNT).isNotNull()).select(
            ACCOUNT, _period_start(ts, period).alias("period_start"), F.lit(name).alias("kind"))

    once = (
        kind(created, c.CREATED, "created")
        .unionByName(kind(closed, c.CLOSED, "closed"))
        .unionByName(kind(reopened, c.REOPENED, "reopened"))
        .distinct()
    )
    return once.groupBy("period_start").agg(
        F.count_if(F.col("kind") == "created").alias("created_accounts"),
        F.count_if(F.col("kind") == "closed").alias("churned_accounts"),
        F.count_if(F.col("kind") == "reopened").alias("reactivated_accounts"),
    )


def cohort_retention(current: DataFrame, period: str = "month") -> DataFrame:
    """Share of each creation cohort that is open or reopened now."""
    retained = F.count_if(F.col(STATUS).isin(c.OPEN, c.REOPENED_STATE))
    return (
        current.groupBy(_period_start(c.CREATED, period).alias("cohort_start"))
        .agg(F.count(F.lit(1)).alias("accounts"), retained.alias("retained_accounts"))
        .withColumn("retention_rate", F.col("retained_accounts") / F.col("accounts"))
    )


def account_transactions_over_time(transactions: DataFrame) -> DataFrame:
    """Transactions per account and day with the running total of the account.

    Summed per day first, so a window holds one row per day however busy the account is.
    """
    daily = (
        transactions.groupBy(ACCOUNT, day_of(c.TX_DATE).alias("transaction_date"))
        .agg(F.sum(c.TX_COUNT).alias(c.TX_COUNT))
    )
    to_date = W.partitionBy(ACCOUNT).orderBy("transaction_date").rowsBetween(
        W.unboundedPreceding, W.currentRow)
    return daily.withColumn("running_total", F.sum(c.TX_COUNT).over(to_date))
