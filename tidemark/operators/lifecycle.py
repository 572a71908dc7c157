"""From lifecycle events to one enriched row per account and kept closure."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark import columns as c
from tidemark.columns import ACCOUNT, CLOSED, REOPENED, STATUS, USER
from tidemark.functions.time import day_of, minute_of_day
from tidemark.operators.closures import deduplicate_closures

PAIR_COLUMNS = [ACCOUNT, USER, c.CREATED, c.ACCOUNT_TYPE, CLOSED, REOPENED]


def first_reopen_after(closures: DataFrame, reopened: DataFrame) -> DataFrame:
    """For each closure the first strictly later reopening of the account, or NULL.

    `closures` must be deduplicated. An account may hold any share of the events, so they are
    never gathered by account in raw form and never paired one by one:

    1. inside each minute of an account, look ahead from the closures to the reopenings;
    2. keep only the first reopening of each minute and look ahead over the whole account.

    Exact copies go first, so a window of step 1 holds at most the 60 million microseconds of
    a minute, and one of step 2 at most one reopening per minute and the kept closures.
    """
    closure_rows = closures.filter(F.col(ACCOUNT).isNotNull()).select(
        ACCOUNT, F.col(CLOSED).alias("ts"), F.lit(False).alias("is_reopen"))
    reopen_rows = (
        reopened.filter(F.col(ACCOUNT).isNotNull() & F.col(REOPENED).isNotNull())
        .select(ACCOUNT, F.col(REOPENED).alias("ts"))
        .distinct()
        .withColumn("is_reopen", F.lit(True))
    )
    # Latest first; on equal timestamps the closure comes before the reopening, which keeps
    # "later" strict. Closures without a timestamp come last and are masked at the end.
    latest_first = [F.col("ts").desc_nulls_last(), F.col("is_reopen").asc()]
    in_minute = W.partitionBy(ACCOUNT, "day", "minute").orderBy(*latest_first)
    in_account = W.partitionBy(ACCOUNT).orderBy(*latest_first)
    seen_so_far = (W.unboundedPreceding, W.currentRow)
    whole = (W.unboundedPreceding, W.unboundedFollowing)

    reopen_ts = F.when(F.col("is_reopen"), F.col("ts"))
    by_minute = (
        closure_rows.unionByName(reopen_rows)
        .withColumns({"day": day_of("ts"), "minute": minute_of_day("ts")})
        .withColumns({
            "same_minute": F.min(reopen_ts).over(in_minute.rowsBetween(*seen_so_far)),
            "first_of_minute": F.min(reopen_ts).over(in_minute.rowsBetween(*whole)),
        })
        .filter(~F.col("is_reopen") | (F.col("ts") == F.col("first_of_minute")))
    )
    next_reopen = F.least(
        F.col("same_minute"), F.min(reopen_ts).over(in_account.rowsBetween(*seen_so_far)))
    return (
        by_minute.select(ACCOUNT, "ts", "is_reopen", "same_minute")
        .withColumn("next_reopen", next_reopen)
        .filter(~F.col("is_reopen"))
        .select(
            ACCOUNT,
            F.col("ts").alias(CLOSED),
            F.when(F.col("ts").isNotNull(), F.col("next_reopen")).alias(REOPENED),
        )
    )


def closure_reopen_pairs(created: DataFrame, closures: DataFrame,
                         reopened: DataFrame) -> DataFrame:
    """One row per account and closure with the reopening that followed.

    Accounts without closure keep one row; events of unknown accounts drop out. Grouping by
    all columns is done early, on the accounts, where copies combine before the shuffle. Rows
    without account id match no event; they go round the join, which would bring all of them
    to one task.
    """
    return _paired(created, closures, reopened).unionByName(_never_closed(created))


def _paired(created: DataFrame, closures: DataFrame, reopened: DataFrame) -> DataFrame:
    accounts = with_id(created.select(ACCOUNT, USER, c.CREATED, c.ACCOUNT_TYPE)).distinct()
    return (
        accounts.join(first_reopen_after(closures, reopened), ACCOUNT, "left")
        .select(*PAIR_COLUMNS)
    )


def _never_closed(created: DataFrame) -> DataFrame:
    """The pairs of created rows without account id: no event is theirs."""
    never = F.lit(None).cast("timestamp_ntz")
    rows = without_id(created.select(ACCOUNT, USER, c.CREATED, c.ACCOUNT_TYPE)).distinct()
    return rows.withColumns({CLOSED: never, REOPENED: never}).select(*PAIR_COLUMNS)


def with_id(df: DataFrame) -> DataFrame:
    """The rows of known accounts, whose id cannot be NULL by its type either.

    So where rows with and without id were united and are parted again, the optimizer drops the
    half of each that the other filter excludes, instead of planning both twice.
    """
    return df.filter(F.col(ACCOUNT).isNotNull()).withColumn(
        ACCOUNT, F.coalesce(ACCOUNT, F.lit("")))


def without_id(df: DataFrame) -> DataFrame:
    """The rows without account id, which match nothing and would be one hot key of a join."""
    return df.filter(F.col(ACCOUNT).isNull()).withColumn(ACCOUNT, F.lit(None).cast("string"))


def account_status(pairs: DataFrame, states: int = 3) -> DataFrame:
    """Add the status of each row; with two states a reopened row reads as open."""
    if states not in (2, 3):
        raise ValueError("states must be 2 or 3")
    after_reopen = c.REOPENED_STATE if states == 3 else c.OPEN
    status = (
        F.when(F.col(CLOSED).isNull(), c.OPEN)
        .when(F.col(REOPENED).isNotNull(), after_reopen)
        .otherwise(c.CLOSED_STATE)
    )
    return pairs.withColumn(STATUS, status)


def multiple_closures(pairs: DataFrame) -> DataFrame:
    """Accounts with more than one kept closure, and how many of them were not reopened."""
    return (
        pairs.groupBy(ACCOUNT, USER)
        .agg(
            F.count(CLOSED).alias("num_closures"),
            F.count_if(F.col(REOPENED).isNull()).alias("num_unreopened_closures"),
        )
        .filter(F.col("num_closures") > 1)
    )


def consecutive_closures(pairs: DataFrame) -> DataFrame:
    """Strict reading of the anomaly: closures directly followed by another closure.

    One row per account and user with `num_unreopened_before_next`, the closures that were not
    reopened before the account's next kept closure.
    """
    following = F.lead(CLOSED).over(W.partitionBy(ACCOUNT, USER).orderBy(CLOSED))
    return (
        pairs.filter(F.col(CLOSED).isNotNull())
        .withColumn("next_closed", following)
        .groupBy(ACCOUNT, USER)
        .agg(F.count_if(
            F.col("next_closed").isNotNull()
            & (F.col(REOPENED).isNull() | (F.col(REOPENED) > F.col("next_closed")))
        ).alias("num_unreopened_before_next"))
        .filter(F.col("num_unreopened_before_next") > 0)
    )


def transaction_totals(transactions: DataFrame) -> DataFrame:
    """Lifetime number of transactions per account."""
    return transactions.groupBy(ACCOUNT).agg(F.sum(c.TX_COUNT).alias(c.TOTAL))


def with_closure_flag(status_rows: DataFrame) -> DataFrame:
    """Add the 0/1 flag of `multiple_closures` without joining the rows to themselves.

    The rows are already partitioned by account, so the counts are windows over that
    partitioning. The flag belongs to the account: if several users share an account id, each
    of their qualifying groups contributes one copy of every row, as a join on the account
    would. With unique account ids the factor is 1. Rows without account id belong to no
    account: their flag is 0, and they stay out of the windows, where they would be one key.
    """
    return _flagged(with_id(status_rows)).unionByName(
        without_id(status_rows).withColumn(c.FLAG, F.lit(0).cast("bigint")))


def _flagged(status_rows: DataFrame) -> DataFrame:
    owner = W.partitionBy(ACCOUNT, USER).orderBy(c.CREATED, CLOSED)
    whole_owner = owner.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    account = W.partitionBy(ACCOUNT)
    groups = F.col("qualifying_groups")
    return (
        status_rows
        .withColumns({
            "num_closures": F.count(CLOSED).over(whole_owner),
            "position": F.row_number().over(owner),
        })
        .withColumns({
            "qualifying_groups": F.count_if(
                (F.col("position") == 1) & (F.col("num_closures") > 1)).over(account),
            "unreopened": F.count_if(F.col(REOPENED).isNull()).over(account),
        })
        .withColumn(c.FLAG, F.when((groups > 0) & (F.col("unreopened") > 0), 1)
                    .otherwise(0).cast("bigint"))
        .withColumn("copy", F.explode(F.sequence(
            F.lit(1), F.greatest(F.lit(1), groups.cast("int")))))
        .drop("num_closures", "position", "qualifying_groups", "unreopened", "copy")
    )


def unified_accounts(created: DataFrame, closed: DataFrame, reopened: DataFrame,
                     transactions: DataFrame, mode: str = "day", gap_seconds: int = 3600,
                     states: int = 3) -> DataFrame:
    """The enriched lifecycle table: status, anomaly flag and transaction total per closure.

    Closures, pairs, flag and totals all meet on the account partitioning, so the joins need
    no shuffle beyond the ones that bring each input to it. Created rows without account id
    have no events: they are open, with total and flag 0, and are added at the end.
    """
    closures = deduplicate_closures(closed, mode, gap_seconds)

    def shown(rows: DataFrame) -> DataFrame:
        return rows.select(
            ACCOUNT, USER, c.ACCOUNT_TYPE, STATUS, c.CREATED, CLOSED, REOPENED,
            F.coalesce(c.TOTAL, F.lit(0).cast("bigint")).alias(c.TOTAL), c.FLAG)

    nothing = F.lit(0).cast("bigint")
    known = account_status(_paired(created, closures, reopened), states)
    unknown = account_status(_never_closed(created), states).withColumns(
        {c.TOTAL: nothing, c.FLAG: nothing})
    return shown(
        _flagged(known).join(transaction_totals(transactions), ACCOUNT, "left")
    ).unionByName(shown(unknown))


def current_account_status(unified: DataFrame) -> DataFrame:
    """One row per account: the row of its latest closure.

    The maximum of a struct that starts with the closure; NULL sorts lowest in a struct, so an
    account without closure keeps its only row. Rows without account id are accounts of their
    own and all stay.
    """
    rest = [n for n in unified.columns if n not in (ACCOUNT, CLOSED)]
    latest = F.max(F.struct(CLOSED, *rest)).alias("latest")
    return (
        with_id(unified).groupBy(ACCOUNT).agg(latest)
        .select(*[F.col(n) if n == ACCOUNT else F.col(f"latest.{n}").alias(n)
                  for n in unified.columns])
        .unionByName(without_id(unified))
    )


def anomalous_accounts(pairs: DataFrame) -> DataFrame:
    """Accounts closed several times with at least one closure never reopened."""
    return (
        pairs.groupBy(ACCOUNT, USER)
        .agg(
            F.max(c.ACCOUNT_TYPE).alias(c.ACCOUNT_TYPE),
            F.min(c.CREATED).alias(c.CREATED),
            F.count(CLOSED).alias("num_closures"),
            F.count_if(F.col(REOPENED).isNull()).alias("num_unreopened_closures"),
        )
        .filter((F.col("num_closures") > 1) & (F.col("num_unreopened_closures") > 0))
    )
