"""Incremental loads of the base tables and of the unified mart."""

from __future__ import annotations

import functools
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark import columns as c
from tidemark.columns import ACCOUNT, USER
from tidemark.functions.time import day_of, moment
from tidemark.operators import incremental as inc
from tidemark.operators.lifecycle import unified_accounts
from tidemark.plans import stored
from tidemark.plans.stored import BUCKET, EVENT_DATE, bucket_of, buckets_of
from tidemark.session import materialise, materialise_observed
from tidemark.sources import contracts
from tidemark.sources.tables import AccountTables

#: Buckets of a new mart. A run rewrites whole buckets: a large mart should have many more than
#: a run touches accounts of, some 100 MB each.
MART_BUCKETS = 32
MART_KEY = [ACCOUNT, c.CLOSED, c.CREATED]

# Contract and delete+insert key of each base table.
BASE_TABLES = {
    "account_created": (contracts.ACCOUNT_CREATED, c.CREATED),
    "account_closed": (contracts.ACCOUNT_CLOSED, c.CLOSED),
    "account_reopened": (contracts.ACCOUNT_REOPENED, c.REOPENED),
    "account_transactions": (contracts.ACCOUNT_TRANSACTIONS, c.TX_DATE),
}


def _read(spark: SparkSession, table: str, contract: T.StructType,
          buckets: Collection[int] | None = None) -> DataFrame:
    """The table, or those buckets of it, with its partition columns."""
    rows = spark.table(table)
    contracts.require_same_columns(rows.drop(EVENT_DATE, BUCKET), contract)
    return rows if buckets is None else rows.filter(F.col(BUCKET).isin(sorted(buckets)))


def read_base(spark: SparkSession, table: str, contract: T.StructType,
              buckets: Collection[int] | None = None) -> DataFrame:
    """The rows of a base table, or of those of its buckets."""
    return contracts.conform(_read(spark, table, contract, buckets), contract)


def read_bases(spark: SparkSession, database: str,
               buckets: Collection[int] | None = None) -> AccountTables:
    """The four base tables, or the same buckets of all of them."""
    return AccountTables(*(read_base(spark, f"{database}.{name}", BASE_TABLES[name][0], buckets)
                           for name in ("account_created", "account_closed", "account_reopened",
                                        "account_transactions")))


def load_base(spark: SparkSession, source: DataFrame, table: str, contract: T.StructType,
              key: str, days: int = 3, buckets: int | None = None) -> DataFrame | None:
    """Load a base table, partitioned by the day of its key and, within, by account if asked to.

    The first run writes everything and returns None; later runs read the look-back window,
    merge it by delete+insert into the days it covers, overwrite those days only, and return the
    batch. The batch is read from the source once and written down, so what is deleted is what
    is inserted. The latest timestamp is looked up in the latest day, not in the whole target.
    A target without any has no look-back window, and nothing is loaded.

    `buckets` is how many parts a day of a new table has, for `rebuild_from_bases`: choose it so
    that a day's bucket is a file worth reading.
    """
    incoming = contracts.conform(source, contract)
    if not stored.exists(spark, table):
        stored.create(incoming.withColumn(EVENT_DATE, day_of(key)), table, [EVENT_DATE], buckets)
        return None
    target = _read(spark, table, contract)
    latest = stored.latest_day(spark, table)
    if latest is None:
        return incoming.filter(F.lit(False))
    start = inc.look_back_start(target.filter(F.col(EVENT_DATE) == F.lit(latest)), key, days)
    batch = materialise(incoming.filter(F.col(key) >= moment(start)), "batch")
    first = start.date()
    recent = contracts.conform(target.filter(F.col(EVENT_DATE) >= F.lit(first)), contract)
    merged = inc.delete_insert(recent, batch, [key])
    covered = [p for p in stored.partitions(spark, table)
               if p[EVENT_DATE] != stored.NULL_PARTITION and p[EVENT_DATE] >= str(first)]
    stored.overwrite(merged.withColumn(EVENT_DATE, day_of(key)), table, covered)
    return batch


def load_bases(spark: SparkSession, sources: AccountTables, database: str,
               buckets: int | None = None) -> DataFrame | None:
    """Loads all four base tables; the accounts with a changed row, or None after a first run.

    Besides the accounts of the batches these are those of the rows a batch may have deleted,
    all that were in its look-back window before. The users of created rows are given too.
    """
    touched = []
    for (name, (contract, key)), source in zip(BASE_TABLES.items(), (
            sources.created, sources.closed, sources.reopened, sources.transactions)):
        table = f"{database}.{name}"
        before = None
        if stored.exists(spark, table) and (latest := stored.latest_day(spark, table)):
            rows = _read(spark, table, contract)
            start = inc.look_back_start(rows.filter(F.col(EVENT_DATE) == F.lit(latest)), key)
            before = materialise(
                rows.filter((F.col(EVENT_DATE) >= F.lit(start.date()))
                            & (F.col(key) >= moment(start))).transform(_owners),
                "accounts_before")
        batch = load_base(spark, source, table, contract, key, buckets=buckets)
        if batch is not None:
            touched += [_owners(batch), *([] if before is None else [before])]
    if not touched:
        return None
    return materialise(functools.reduce(DataFrame.unionByName, touched).distinct(),
                       "touched_accounts")


def _owners(rows: DataFrame) -> DataFrame:
    """The accounts of rows, and their users if the rows have them."""
    user = F.col(USER) if USER in rows.columns else F.lit(None).cast("string").alias(USER)
    return rows.select(ACCOUNT, user).distinct()


def with_buckets(rows: DataFrame, name: str, buckets: int,
                 by: str = ACCOUNT) -> tuple[DataFrame, list[int]]:
    """The rows written down, and the buckets of their accounts: at most all."""
    written, seen = materialise_observed(rows, name, held=F.collect_set(bucket_of(buckets, by)))
    return written, sorted(seen["held"])


def read_mart(spark: SparkSession, table: str,
              buckets: Collection[int] | None = None) -> DataFrame:
    return read_base(spark, table, contracts.UNIFIED_ACCOUNTS, buckets)


def _create_mart(rows: DataFrame, table: str, buckets: int) -> DataFrame:
    stored.create(contracts.conform(rows, contracts.UNIFIED_ACCOUNTS), table, buckets=buckets)
    return read_mart(rows.sparkSession, table)


def load_mart(spark: SparkSession, unified: DataFrame, table: str,
              null_safe: bool = False, buckets: int = MART_BUCKETS) -> DataFrame:
    """Merge the changed rows of the unified table into the mart by its three-column key.

    Only the buckets of changed accounts are read and rewritten. As declared, with its limits:
    an account's old `open` row has no closure timestamp, so it matches no key and stays once
    the account closes, and totals alone do not make a row "changed". `rebuild_touched` has
    neither limit.
    """
    if not stored.exists(spark, table):
        return _create_mart(unified, table, buckets)
    unified = contracts.conform(unified, contracts.UNIFIED_ACCOUNTS)
    batch, held = with_buckets(inc.changed_rows(unified, read_mart(spark, table)),
                                "changed_rows", buckets_of(spark, table))
    merged = inc.delete_insert(read_mart(spark, table, held), batch, MART_KEY, null_safe)
    stored.overwrite(merged, table, stored.places(held))
    return read_mart(spark, table)


def load_by_content(spark: SparkSession, unified: DataFrame, table: str,
                    buckets: int = MART_BUCKETS) -> tuple[DataFrame, DataFrame | None]:
    """Bring the mart to the unified table by comparing contents; the mart and what changed.

    The mart keeps a wide hash of every row, and only keys and hashes of it are read to find new,
    changed and vanished rows (`inc.content_changes`), whatever column differs, totals included.
    Only the buckets that hold a difference are written. After a first run there are no changes.
    """
    hashed = inc.with_row_hash(contracts.conform(unified, contracts.UNIFIED_ACCOUNTS))
    if not stored.exists(spark, table):
        stored.create(hashed, table, buckets=buckets)
        return _shown(spark, table), None
    now = materialise(hashed, "unified_now")
    changes, held = with_buckets(
        inc.content_changes(now, spark.table(table), MART_KEY), "content_changes",
        buckets_of(spark, table))
    bucket = bucket_of(buckets_of(spark, table))
    stored.overwrite(now.filter(bucket.isin(held)), table, stored.places(held))
    return _shown(spark, table), changes


def _shown(spark: SparkSession, table: str) -> DataFrame:
    return contracts.conform(spark.table(table), contracts.UNIFIED_ACCOUNTS)


def rebuild_touched(spark: SparkSession, tables: AccountTables, touched: DataFrame,
                    table: str, buckets: int = MART_BUCKETS) -> DataFrame:
    """Recompute every row of the touched accounts and put them in place of the old ones.

    Rows without account id are one account here: if one is touched, all are recomputed. An
    account that is not touched keeps its rows, whatever happened to its events since. Only the
    buckets of touched accounts are rewritten. How many accounts are touched changes nothing
    but the cost. The tables are read as a whole; `rebuild_from_bases` reads their buckets.
    """
    if not stored.exists(spark, table):
        return _create_mart(_unified(tables), table, buckets)
    touched, held = with_buckets(touched, "touched_accounts", buckets_of(spark, table))
    fresh = _unified(tables.map(lambda t: inc.of_accounts(t, touched)))
    kept = inc.of_accounts(read_mart(spark, table, held), touched, inside=False)
    stored.overwrite(kept.unionByName(fresh), table, stored.places(held))
    return read_mart(spark, table)


def rebuild_from_bases(spark: SparkSession, database: str, touched: DataFrame | None,
                       table: str) -> DataFrame:
    """Recompute the buckets of the touched accounts from the same buckets of the base tables.

    The base tables were created by `load_bases` with a number of buckets, which is the new
    mart's too. A bucket is recomputed as a whole, so its old rows are not read, and no row of a
    base table is joined with the touched accounts. `touched` is what `load_bases` returned; None
    builds the mart.
    """
    counts = {buckets_of(spark, f"{database}.{name}") for name in BASE_TABLES}
    if len(counts) != 1 or None in counts:
        raise ValueError(f"the base tables are cut into {counts} buckets")
    if touched is None or not stored.exists(spark, table):
        return _create_mart(_unified(read_bases(spark, database)), table, *counts)
    if buckets_of(spark, table) not in counts:
        raise ValueError(f"the mart is cut into other buckets than the base tables' {counts}")
    _, held = with_buckets(touched, "touched_accounts", *counts)
    if held:
        stored.overwrite(_unified(read_bases(spark, database, held)), table, stored.places(held))
    return read_mart(spark, table)


def _unified(tables: AccountTables) -> DataFrame:
    rows = unified_accounts(tables.created, tables.closed, tables.reopened, tables.transactions)
    return contracts.conform(rows, contracts.UNIFIED_ACCOUNTS)
