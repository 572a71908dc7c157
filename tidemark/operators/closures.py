"""Removing repeated closure events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark.columns import ACCOUNT, CLOSED
from tidemark.functions.time import day_of, second_of_day


def latest_closure_per_day(closures: DataFrame) -> DataFrame:
    """The last closure of each account and calendar day.

    A maximum instead of a ranking: it combines before the shuffle, so copies and busy
    accounts shrink to one row per day on the map side.
    """
    return (
        closures.groupBy(ACCOUNT, day_of(CLOSED).alias("day"))
        .agg(F.max(CLOSED).alias(CLOSED))
        .select(ACCOUNT, CLOSED)
    )


def closures_without_close_successor(closures: DataFrame, gap_seconds: int = 3600) -> DataFrame:
    """Drop a closure when the account has another one at most `gap_seconds` later that day.

    Within a cell of `gap_seconds` every closure but the last has a close successor, so only
    the first and last of each cell matter. The window then sees one row per cell: never more
    than 86400 / gap_seconds + 1 rows per account and day.
    """
    if gap_seconds < 1:
        raise ValueError("gap_seconds must be at least 1")
    cells = (
        closures.groupBy(
            ACCOUNT,
            day_of(CLOSED).alias("day"),
            F.floor(second_of_day(CLOSED) / gap_seconds).alias("cell"),
        )
        .agg(F.min(CLOSED).alias("first_ts"), F.max(CLOSED).alias("last_ts"))
    )
    next_ts = F.lead("first_ts").over(W.partitionBy(ACCOUNT, "day").orderBy("cell"))
    gap = F.make_dt_interval(secs=F.lit(gap_seconds))
    return (
        cells.withColumn("next_ts", next_ts)
        .filter(F.col("next_ts").isNull() | (F.col("next_ts") > F.col("last_ts") + gap))
        .select(ACCOUNT, F.col("last_ts").alias(CLOSED))
    )


def deduplicate_closures(closures: DataFrame, mode: str = "day",
                         gap_seconds: int = 3600) -> DataFrame:
    """`mode="day"` keeps the latest closure per day; `mode="gap"` merges only close ones."""
    if mode == "day":
        return latest_closure_per_day(closures)
    if mode == "gap":
        return closures_without_close_successor(closures, gap_seconds)
    raise ValueError(f"unknown mode {mode!r}")
