"""Account tables derived from a generic `events` table.

Gives the operators something to run on where only an event stream
(event_id, ts, user_id, event_type, value, props) exists. Every event row counts; what it means
follows from its type alone:

    signup           the first one opens the account
    error            closes the account
    click            reopens the account
    purchase, view   daily activity; only purchases count as transactions

The account's type follows from the largest value of its signups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import columns as c
from tidemark.sources.tables import AccountTables, conform_all

# Upper bound of the largest signup value per account type; above the last one the type is
# NULL. The type names are fixed values of the data model.
TYPE_BANDS = [(120, "uk_retail"), (180, "uk_retail_pot"), (300, "uk_retail_joint")]


def _account() -> Column:
    return F.concat(F.lit("acct-"), F.col("user_id").cast("string")).alias(c.ACCOUNT)


def _account_type(largest: Column) -> Column:
    kind = F.when(largest <= TYPE_BANDS[0][0], TYPE_BANDS[0][1])
    for bound, name in TYPE_BANDS[1:]:
        kind = kind.when(largest <= bound, name)
    return kind


def account_tables(events: DataFrame) -> AccountTables:
    created = (
        events.filter(F.col("event_type") == "signup")
        .groupBy("user_id")
        .agg(F.min("ts").alias(c.CREATED), F.max("value").alias("largest"))
        .select(
            _account(),
            F.concat(F.lit("user-"),
                     F.floor(F.col("user_id") / 3).cast("string")).alias(c.USER),
            _account_type(F.col("largest")).alias(c.ACCOUNT_TYPE),
            c.CREATED,
        )
    )
    closed = (
        events.filter(F.col("event_type") == "error")
        .select(_account(), F.col("ts").alias(c.CLOSED))
    )
    reopened = (
        events.filter(F.col("event_type") == "click")
        .select(_account(), F.col("ts").alias(c.REOPENED))
    )
    transactions = (
        events.filter(F.col("event_type").isin("purchase", "view"))
        .groupBy("user_id", F.col("ts").cast("date").alias("day"))
        .agg(F.count_if(F.col("event_type") == "purchase").alias(c.TX_COUNT))
        .select(_account(), c.TX_COUNT, F.col("day").cast("timestamp_ntz").alias(c.TX_DATE))
    )
    return conform_all(created, closed, reopened, transactions)


def read_account_tables(spark: SparkSession, folder: str) -> AccountTables:
    return account_tables(spark.read.parquet(f"{folder}/events.parquet"))
