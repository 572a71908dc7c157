"""Reading the four account source tables."""

from __future__ import annotations

from dataclasses import dataclass, fields
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources import contracts


@dataclass(frozen=True)
class AccountTables:
    """The four conformed inputs."""

    created: DataFrame
    closed: DataFrame
    reopened: DataFrame
    transactions: DataFrame

    def map(self, change: Callable[[DataFrame], DataFrame]) -> AccountTables:
        return AccountTables(*(change(getattr(self, f.name)) for f in fields(self)))


def conform_all(created: DataFrame, closed: DataFrame, reopened: DataFrame,
                transactions: DataFrame) -> AccountTables:
    return AccountTables(
        created=contracts.conform(created, contracts.ACCOUNT_CREATED),
        closed=contracts.conform(closed, contracts.ACCOUNT_CLOSED),
        reopened=contracts.conform(reopened, contracts.ACCOUNT_REOPENED),
        transactions=contracts.conform(transactions, contracts.ACCOUNT_TRANSACTIONS),
    )


def read_folder(spark: SparkSession, root: str, fmt: str = "parquet") -> AccountTables:
    """Read `<root>/account_created` and its three siblings."""
    def read(name: str) -> DataFrame:
        return spark.read.format(fmt).load(f"{root}/{name}")

    return conform_all(read("account_created"), read("account_closed"),
                       read("account_reopened"), read("account_transactions"))


def read_database(spark: SparkSession, database: str) -> AccountTables:
    """Read the four tables from a catalog database."""
    def read(name: str) -> DataFrame:
        return spark.table(f"{database}.{name}")

    return conform_all(read("account_created"), read("account_closed"),
                       read("account_reopened"), read("account_transactions"))


def development_limit(df: DataFrame, enabled: bool, rows: int) -> DataFrame:
    """At most `rows` arbitrary rows while developing; everything otherwise.

    Only for trying things out: no other plan calls it, and `rows` has no default.
    """
    return df.limit(rows) if enabled else df
