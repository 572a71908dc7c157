"""Data-quality checks. Each returns the failing rows, or counts of them, as a DataFrame."""

from __future__ import annotations

import datetime
import functools
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import columns as c
from tidemark.columns import ACCOUNT
from tidemark.functions.time import moment
from tidemark.operators.lifecycle import transaction_totals

FAILURES = "failures"


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, failures) for each column, from one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.col(n).alias(FAILURES)) for n in columns
    ])))


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def duplicated_keys(df: DataFrame, key: list[str], ignore_nulls: bool = False) -> DataFrame:
    """Keys that occur more than once, with the number of rows.

    NULLs form a key of their own unless `ignore_nulls`, the rule for one unique column.
    """
    rows = df.dropna(subset=key) if ignore_nulls else df
    return (
        rows.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def unaccepted_values(df: DataFrame, column: str, accepted: list[str]) -> DataFrame:
    """Values outside the accepted list, with the number of rows. NULL is not judged."""
    return (
        df.filter(~F.col(column).isin(accepted))
        .groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    )


def orphaned_keys(child: DataFrame, parent: DataFrame, key: str = ACCOUNT) -> DataFrame:
    """Child keys without a parent row, with the number of child rows. NULL is not judged."""
    return orphaned_keys_of({"": child}, parent, key).drop("child")


def orphaned_keys_of(children: Mapping[str, DataFrame], parent: DataFrame,
                     key: str = ACCOUNT) -> DataFrame:
    """(child, key, row_count): the orphaned keys of several tables by name, in one plan.

    Not a join: the keys of the children and the parent, tagged by where they are from, are
    counted together by one aggregate, which combines before its shuffle, so that a key with many
    rows is not a hot one.
    """
    names = list(children)
    parts = [df.select(F.col(key).alias(key), F.lit(place).alias("place"))
             for place, df in enumerate([*children.values(), parent])]
    counted = (
        functools.reduce(DataFrame.unionByName, parts).filter(F.col(key).isNotNull())
        .groupBy(key).agg(*[F.count_if(F.col("place") == i).alias(f"n{i}")
                            for i in range(len(parts))])
        .filter(F.col(f"n{len(names)}") == 0)
    )
    return counted.select(key, F.inline(F.array(*[
        F.struct(F.lit(name).alias("child"), F.col(f"n{i}").alias("row_count"))
        for i, name in enumerate(names)]))).filter("row_count > 0").select(
        "child", key, "row_count")


def violating_rows(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which the rule is false. A rule that is NULL is not judged."""
    return df.filter(~rule)


def freshness(df: DataFrame, ts: str, as_of: datetime.datetime,
              warn_after: datetime.timedelta = datetime.timedelta(hours=8)) -> DataFrame:
    """Latest timestamp, its age at `as_of` and whether the table is stale.

    An empty table has no latest timestamp and counts as stale.
    """
    now = moment(as_of)
    stale_before = moment(as_of - warn_after)
    return (
        df.agg(F.max(ts).alias("latest_ts"))
        .select(
            "latest_ts",
            F.timestamp_diff("SECOND", F.col("latest_ts"), now).alias("age_seconds"),
            F.coalesce(F.col("latest_ts") < stale_before, F.lit(True)).alias("is_stale"),
        )
    )


def lifecycle_order_violations(unified: DataFrame) -> DataFrame:
    """Rows closed before they were created, or reopened before they were closed."""
    return unified.filter(
        (F.col(c.CLOSED) < F.col(c.CREATED)) | (F.col(c.REOPENED) < F.col(c.CLOSED)))


def total_mismatches(unified: DataFrame, transactions: DataFrame) -> DataFrame:
    """Accounts whose published total differs from the sum of their transactions.

    One row per account and total on one side, one sum per account on the other: the
    per-closure rows never meet the transaction rows. No transactions means 0.
    """
    published = unified.select(ACCOUNT, c.TOTAL).distinct()
    expected = transaction_totals(transactions).withColumnRenamed(c.TOTAL, "expected_total")
    return (
        published.join(expected, ACCOUNT, "left")
        .withColumn("expected_total", F.coalesce("expected_total", F.lit(0).cast("bigint")))
        .filter(~F.col(c.TOTAL).eqNullSafe(F.col("expected_total")))
    )


def keys_with_several(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one distinct value; an account with several users, by name."""
    return (
        df.groupBy(key).agg(F.count_distinct(value).alias("distinct_values"))
        .filter(F.col("distinct_values") > 1)
    )
