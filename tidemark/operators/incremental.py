"""Selecting the rows of an incremental run and merging them into the target."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import columns as c
from tidemark.columns import ACCOUNT
from tidemark.functions.time import moment

ROW_HASH = "row_hash"


def look_back_start(target: DataFrame, ts: str, days: int = 3):
    """The moment `days` before the target's latest timestamp; None if there is none."""
    return target.agg((F.max(ts) - F.make_dt_interval(days=F.lit(days))).alias("start")).first()[0]


def look_back_starts(targets: list[tuple[DataFrame, str]], days: int = 3) -> list:
    """`look_back_start` of several targets, each with its timestamp column, in one job."""
    latest = functools.reduce(DataFrame.unionByName, [
        df.agg((F.max(ts) - F.make_dt_interval(days=F.lit(days))).alias("start"))
        .withColumn("place", F.lit(i)) for i, (df, ts) in enumerate(targets)])
    return [r.start for r in sorted(latest.collect(), key=lambda r: r.place)]


def look_back(source: DataFrame, target: DataFrame, ts: str, days: int = 3) -> DataFrame:
    """Source rows from `days` before the target's latest timestamp on, inclusive.

    The start is one value fetched from the target, so that the filter reaches the scan of the
    source. An empty target has no latest timestamp and selects nothing.
    """
    return since(source, ts, look_back_start(target, ts, days))


def since(source: DataFrame, ts: str, start) -> DataFrame:
    """Source rows from a moment on; none if there is no moment."""
    return source.filter(F.lit(False) if start is None else F.col(ts) >= moment(start))


def _matches(keys: list[str], prefix: str, null_safe: bool) -> Column:
    same = [F.col(k).eqNullSafe(F.col(prefix + k)) if null_safe
            else F.col(k) == F.col(prefix + k) for k in keys]
    return functools.reduce(operator.and_, same)


def delete_insert(target: DataFrame, batch: DataFrame, keys: list[str],
                  null_safe: bool = False) -> DataFrame:
    """Target rows whose key is not in the batch, and the batch.

    A NULL in a key matches nothing unless `null_safe`. The batch shrinks to its distinct keys,
    so the target is the only side that can be skewed, and adaptive execution splits it.
    """
    batch_keys = batch.select([F.col(k).alias(f"batch_{k}") for k in keys]).distinct()
    kept = target.join(batch_keys, _matches(keys, "batch_", null_safe), "left_anti")
    return kept.unionByName(batch)


def changed_rows(unified: DataFrame, target: DataFrame) -> DataFrame:
    """Rows whose created, closed or reopened timestamp reaches the target's latest one."""
    latest = target.agg(*[F.max(n).alias(n) for n in (c.CREATED, c.CLOSED, c.REOPENED)]).first()
    reached = [F.col(n) >= moment(latest[n])
               for n in (c.CREATED, c.CLOSED, c.REOPENED) if latest[n] is not None]
    return unified.filter(functools.reduce(operator.or_, reached, F.lit(False)))


def with_row_hash(df: DataFrame, name: str = ROW_HASH) -> DataFrame:
    """Adds 128 bits of hash over all columns, in which NULLs count with their place."""
    parts = [part for n in df.columns for part in (F.col(n).isNull(), F.col(n))]
    halves = [F.lower(F.hex(F.xxhash64(F.lit(seed), *parts))) for seed in (1, 2)]
    return df.withColumn(name, F.concat(*[F.lpad(h, 16, "0") for h in halves]))


def content_changes(now: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    """(key, change): keys whose rows differ by their hash: `new`, `changed` or `vanished`.

    Both sides are read by key and hash only and counted against each other, NULL keys and
    repeated rows included, in one shuffle by the key.
    """
    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*key, ROW_HASH, F.lit(sign).alias("sign"))

    differing = (
        side(now, 1).unionByName(side(stored, -1)).repartition(*key)
        .groupBy(*key, ROW_HASH).agg(F.sum("sign").alias("more")).filter(F.col("more") != 0)
    )
    change = (
        F.when(F.min("more") > 0, "new").when(F.max("more") < 0, "vanished").otherwise("changed"))
    return differing.groupBy(*key).agg(change.alias("change"))


def touched_accounts(*batches: DataFrame) -> DataFrame:
    """The distinct accounts in any of the batches; rows without account id count as one."""
    keys = [b.select(ACCOUNT) for b in batches]
    return functools.reduce(DataFrame.unionByName, keys).distinct()


def of_accounts(df: DataFrame, accounts: DataFrame, inside: bool = True) -> DataFrame:
    """Rows of the given accounts, or of all others; a NULL account id equals NULL."""
    keys = accounts.select(F.col(ACCOUNT).alias(f"touched_{ACCOUNT}"))
    return df.join(keys, _matches([ACCOUNT], "touched_", True),
                   "left_semi" if inside else "left_anti")
