"""Open accounts and the rolling active-user rate per calculation date."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark import columns as c
from tidemark.columns import ACCOUNT, CALC_DATE, USER
from tidemark.functions.steps import step_pair, value_on_step
from tidemark.functions.time import day_of
from tidemark.operators.lifecycle import with_id, without_id

OPEN_ACCOUNTS = "open_accounts"
RECENT = "transactions_in_last_7_days"


def calculation_dates(transactions: DataFrame) -> DataFrame:
    """The distinct days on which anything was recorded."""
    return transactions.select(day_of(c.TX_DATE).alias(CALC_DATE)).distinct()


def open_spans(status_rows: DataFrame) -> DataFrame:
    """(account, user, first_day, last_day) of every row that reads open or reopened.

    A span runs from the day of creation through the day of the row's closure; without
    closure `last_day` is NULL.
    """
    return (
        status_rows.filter(F.col(c.STATUS).isin(c.OPEN, c.REOPENED_STATE))
        .select(ACCOUNT, USER, day_of(c.CREATED).alias("first_day"),
                day_of(c.CLOSED).alias("last_day"))
        .filter(F.col("first_day").isNotNull()
                & (F.col("last_day").isNull() | (F.col("first_day") <= F.col("last_day"))))
    )


def open_spans_from_events(created: DataFrame, closures: DataFrame,
                           reopened: DataFrame) -> DataFrame:
    """The same spans as from the status rows, without pairing closures and reopenings.

    A closure was reopened exactly if it lies before the account's last reopening, so one
    timestamp per account, combined before the shuffle, replaces all reopenings. Rows without
    account id were never closed; they go round the joins.
    """
    accounts = created.select(ACCOUNT, USER, c.CREATED, c.ACCOUNT_TYPE).distinct()
    last_reopened = reopened.groupBy(ACCOUNT).agg(F.max(c.REOPENED).alias("last_reopened"))
    known = (
        with_id(accounts)
        .join(closures, ACCOUNT, "left")
        .join(last_reopened, ACCOUNT, "left")
        .filter(F.col(c.CLOSED).isNull() | (F.col(c.CLOSED) < F.col("last_reopened")))
        .select(ACCOUNT, USER, c.CREATED, c.CLOSED)
    )
    unknown = without_id(accounts).select(
        ACCOUNT, USER, c.CREATED, F.lit(None).cast("timestamp_ntz").alias(c.CLOSED))
    return (
        known.unionByName(unknown)
        .withColumn(c.STATUS, F.when(F.col(c.CLOSED).isNull(), c.OPEN)
                    .otherwise(c.REOPENED_STATE))
        .transform(open_spans)
    )


def open_intervals(spans: DataFrame) -> DataFrame:
    """One interval per account and user: the union of spans that start on the same day.

    That is how `open_spans` come: from the creation to each closure. The union reaches from
    the first day to the latest last day, without end if one span has none.
    """
    return (
        spans.groupBy(ACCOUNT, USER)
        .agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"),
             F.bool_or(F.col("last_day").isNull()).alias("endless"))
        .select(ACCOUNT, USER, "first_day",
                F.when(~F.col("endless"), F.col("last_day")).alias("last_day"))
    )


def _days_between(spans: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per span and calculation date it covers.

    The range join as generated days plus an equality. The dates are broadcast: distinct
    values of a DATE are at most one per calendar day, some thousands, and could not exceed
    the 3.7 million days the type holds. A shuffled join would gather all rows of a date.
    """
    bounds = dates.agg(F.struct(F.min(CALC_DATE).alias("first"),
                                F.max(CALC_DATE).alias("last"))).scalar()
    return (
        spans
        .withColumn("from_day", F.greatest(F.col("first_day"), bounds["first"]))
        .withColumn("to_day", F.least(F.col("last_day"), bounds["last"]))
        .filter(F.col("from_day") <= F.col("to_day"))
        .withColumn(CALC_DATE, F.explode(F.sequence("from_day", "to_day")))
        .drop("from_day", "to_day")
        .join(F.broadcast(dates), CALC_DATE, "left_semi")
    )


def open_accounts_by_date(spans: DataFrame, dates: DataFrame) -> DataFrame:
    """Every (calculation date, account, user) a span covers, one row per span."""
    return _days_between(spans, dates).select(CALC_DATE, ACCOUNT, USER)


def _active_days(transactions: DataFrame, min_transactions: int | None) -> DataFrame:
    """Per account the list of its days with transaction rows and how many.

    Counted by day first, so a list is no longer than the calendar.
    """
    counted = transactions.filter(F.col(c.TX_DATE).isNotNull())
    if min_transactions is not None:
        counted = counted.filter(F.col(c.TX_COUNT) >= min_transactions)
    return (
        counted.groupBy(ACCOUNT, day_of(c.TX_DATE).alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(ACCOUNT).agg(F.collect_list(F.struct("day", "n")).alias("active_days"))
    )


def _user_steps(spans: DataFrame, transactions: DataFrame, window_days: int,
                min_transactions: int | None) -> DataFrame:
    """Per user and day of change: open spans, open accounts and recent activity from then on.

    Coverage and activity are step functions of the account. They meet as two short lists per
    account, of its coverage and of its active days. Both are summed to one entry per day
    first, so no list outgrows the calendar, and neither long spans nor busy accounts or users
    multiply rows. Spans without account id have no activity and are no open accounts; they
    join the others when those are summed by user. The changes of spans and activity are
    returned too.
    """
    one, nothing = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    covered = (
        spans.select(ACCOUNT, USER, F.inline(step_pair(
            F.col("first_day"), F.col("last_day"), d_spans=one)))
        .filter(F.col("day").isNotNull())
    )
    coverage = (
        with_id(covered)
        .groupBy(ACCOUNT, USER, "day").agg(F.sum("d_spans").alias("d_spans"))
        .groupBy(ACCOUNT, USER).agg(F.collect_list(F.struct("day", "d_spans")).alias("coverage"))
    )
    by_account = (
        coverage.join(_active_days(transactions, min_transactions), ACCOUNT, "left")
        .select(ACCOUNT, USER, F.inline(F.concat(
            F.transform("coverage", lambda s: F.struct(
                s["day"].alias("day"), s["d_spans"].alias("d_spans"), nothing.alias("d_recent"))),
            F.flatten(F.transform(
                F.coalesce("active_days", F.array()),
                lambda a: step_pair(a["day"], F.date_add(a["day"], window_days),
                                    d_spans=nothing, d_recent=a["n"]))),
        )))
        .groupBy(ACCOUNT, USER, "day")
        .agg(F.sum("d_spans").alias("d_spans"), F.sum("d_recent").alias("d_recent"))
    )
    owner = [ACCOUNT, USER]

    def open_accounts(spans: Column) -> Column:
        return (spans > 0).cast("bigint")

    spans_now, recent_now = F.col("spans"), F.col("recent")
    spans_before, recent_before = spans_now - F.col("d_spans"), recent_now - F.col("d_recent")
    changes = (
        by_account
        .withColumns({"spans": value_on_step("d_spans", owner),
                      "recent": value_on_step("d_recent", owner)})
        .select(USER, "day", "d_spans",
                (open_accounts(spans_now) - open_accounts(spans_before)).alias("d_open"),
                (spans_now * recent_now - spans_before * recent_before).alias("d_recent"))
        .filter((F.col("d_spans") != 0) | (F.col("d_recent") != 0))
        .unionByName(without_id(covered).select(
            USER, "day", "d_spans", nothing.alias("d_open"), nothing.alias("d_recent")))
        .groupBy(USER, "day")
        .agg(*[F.sum(f"d_{n}").alias(f"d_{n}") for n in ("spans", "open", "recent")])
    )
    return changes.select(
        USER, "day", "d_spans", "d_recent",
        value_on_step("d_spans", [USER]).alias("open_spans"),
        value_on_step("d_open", [USER]).alias(OPEN_ACCOUNTS),
        value_on_step("d_recent", [USER]).alias(RECENT),
    )


def user_activity_by_date(spans: DataFrame, transactions: DataFrame, window_days: int = 7,
                          min_transactions: int | None = None) -> DataFrame:
    """Per calculation date and user with an open span: open accounts and recent activity.

    Activity counts transaction rows of the last `window_days` days and the day itself, once
    per span of the account that covers the date. `min_transactions` ignores smaller rows.
    """
    until_next = F.date_sub(F.lead("day").over(W.partitionBy(USER).orderBy("day")), 1)
    segments = (
        _user_steps(spans, transactions, window_days, min_transactions)
        .withColumn("last_day", until_next)
        .withColumnRenamed("day", "first_day")
        .filter(F.col("open_spans") > 0)
    )
    return (
        _days_between(segments, calculation_dates(transactions))
        .select(CALC_DATE, USER, OPEN_ACCOUNTS, RECENT)
    )


def active_user_rate(intervals: DataFrame, transactions: DataFrame, window_days: int = 7,
                     min_transactions: int | None = None) -> DataFrame:
    """Share of the users with an open account who were active in the window, per date.

    Takes `open_intervals`, one interval per account and user, so that the account's list of
    active days is read once. `active_user_rate_of_spans` takes any number of spans.

    An account's interval makes its user open, and where it overlaps the window of an active
    day, active. Both are summed as steps per user, so the cost follows the number of events
    and not the days accounts stay open. Only the last running sum is not partitioned; its
    input is one row per calendar day.
    """
    return _rate_from_steps(
        with_levels(user_steps(intervals, transactions, window_days, min_transactions)),
        transactions)


def user_steps(intervals: DataFrame, transactions: DataFrame, window_days: int = 7,
               min_transactions: int | None = None) -> DataFrame:
    """Per user and day of change: how many intervals open, and overlaps with activity begin."""
    one, nothing = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def in_reach(active: Column) -> Column:
        reaches_start = F.date_add(active["day"], window_days) >= F.col("first_day")
        return reaches_start & (F.col("last_day").isNull() | (active["day"] <= F.col("last_day")))

    def active_steps(active: Column) -> Column:
        return step_pair(
            F.greatest(F.col("first_day"), active["day"]),
            F.least(F.col("last_day"), F.date_add(active["day"], window_days)),
            d_open=nothing, d_active=one)

    near = F.filter(F.coalesce("active_days", F.array()), in_reach)
    days = _active_days(transactions, min_transactions)
    owned = intervals.filter(F.col(USER).isNotNull())
    return (
        with_id(owned).join(days, ACCOUNT, "left")
        # Without account id there is no activity, and no need to meet in one task.
        .unionByName(without_id(owned).withColumn(
            "active_days", F.lit(None).cast(days.schema["active_days"].dataType)))
        .select(USER, F.inline(F.concat(
            step_pair(F.col("first_day"), F.col("last_day"), d_open=one, d_active=nothing),
            F.flatten(F.transform(near, active_steps)),
        )))
        .filter(F.col("day").isNotNull())
        .groupBy(USER, "day")
        .agg(F.sum("d_open").alias("d_open"), F.sum("d_active").alias("d_active"))
    )


def with_levels(steps: DataFrame) -> DataFrame:
    """The steps of users with what they add up to: `open` intervals and `active` ones."""
    return steps.select("day", "d_open", "d_active",
                        value_on_step("d_open", [USER]).alias("open"),
                        value_on_step("d_active", [USER]).alias("active"))


def active_user_rate_of_spans(spans: DataFrame, transactions: DataFrame, window_days: int = 7,
                              min_transactions: int | None = None) -> DataFrame:
    """The same rate from spans of which an account may have any number, as `spans_as_of` gives.

    Coverage and activity of an account are summed as steps before they meet, so an account
    that reopens every day costs as many steps as it has days, not spans times active days.
    """
    steps = _user_steps(spans.filter(F.col(USER).isNotNull()), transactions, window_days,
                        min_transactions)
    return _rate_from_steps(
        steps.select("day", F.col("d_spans").alias("d_open"), F.col("d_recent").alias("d_active"),
                     F.col("open_spans").alias("open"), F.col(RECENT).alias("active")),
        transactions)


def daily_changes(users: DataFrame) -> DataFrame:
    """Per day how many users become open or active, less those who cease, from `with_levels`."""
    def crossing(value: str) -> Column:
        """+1 where the value rises above 0, -1 where it falls back to 0."""
        before = F.col(value) - F.col(f"d_{value}")
        return (F.col(value) > 0).cast("bigint") - (before > 0).cast("bigint")

    return users.select("day", crossing("open").alias("d_open"),
                        crossing("active").alias("d_active"))


def _rate_from_steps(users: DataFrame, transactions: DataFrame) -> DataFrame:
    """The rate from steps of the users: `open` and `active` (above 0 or not) and their changes."""
    return rate_of_days(daily_changes(users), transactions.select(day_of(c.TX_DATE).alias("day")))


def rate_of_days(changes: DataFrame, dates: DataFrame) -> DataFrame:
    """The rate on the `dates` (day, repeated or not) from the changes of users per day."""
    nothing = F.lit(0).cast("bigint")
    wanted = dates.select("day", nothing.alias("d_open"), nothing.alias("d_active"),
                          F.lit(True).alias("wanted")).filter(F.col("day").isNotNull())
    per_day = (
        changes.withColumn("wanted", F.lit(False)).unionByName(wanted).groupBy("day")
        .agg(F.sum("d_open").alias("d_open"), F.sum("d_active").alias("d_active"),
             F.max("wanted").alias("wanted"))
    )
    return _rate(
        per_day.select(
            F.col("day").alias(CALC_DATE), "wanted",
            value_on_step("d_active", []).alias("active_users"),
            value_on_step("d_open", []).alias("total_open_users"),
        ).filter("wanted AND total_open_users > 0")
    )


def active_user_rate_from_activity(activity: DataFrame) -> DataFrame:
    """The rate from `user_activity_by_date`, which holds each user once per date."""
    return _rate(
        activity.filter(F.col(USER).isNotNull()).groupBy(CALC_DATE)
        .agg(F.count_if(F.col(RECENT) > 0).alias("active_users"),
             F.count(F.lit(1)).alias("total_open_users"))
    )


def _rate(counts: DataFrame) -> DataFrame:
    return counts.select(
        CALC_DATE, "active_users", "total_open_users",
        (F.col("active_users") / F.col("total_open_users")).alias("seven_day_active_user_rate"),
    )


def user_drilldown(activity: DataFrame, user_id: str,
                   on_date: datetime.date | str | None = None) -> DataFrame:
    """The activity of one user, on one date or all. The filter reaches the spans' scan."""
    rows = activity.filter(F.col(USER) == user_id)
    return rows if on_date is None else rows.filter(F.col(CALC_DATE) == F.lit(on_date).cast("date"))


def spans_as_of(created: DataFrame, closed: DataFrame, reopened: DataFrame) -> DataFrame:
    """Days on which each account really was open, as spans for the functions above.

    An account is open from its creation or a reopening through the day of its next event.
    By day that needs only two facts, both combined before the shuffle: whether an opening
    event happened, and whether the last event was one. Equal timestamps rank created,
    reopened, closed.
    """
    def events(df: DataFrame, ts: str, rank: int) -> DataFrame:
        return with_id(df.filter(F.col(ts).isNotNull())).select(
            ACCOUNT, F.col(ts).alias("ts"), F.lit(rank).alias("rank"))

    closing = 2
    days = (
        events(created, c.CREATED, 0)
        .unionByName(events(reopened, c.REOPENED, 1))
        .unionByName(events(closed, c.CLOSED, closing))
        .groupBy(ACCOUNT, day_of("ts").alias("first_day"))
        .agg(F.min("rank").alias("lowest"), F.max(F.struct("ts", "rank")).alias("last"))
    )
    next_day = F.lead("first_day").over(W.partitionBy(ACCOUNT).orderBy("first_day"))
    stays_open = F.col("last.rank") < closing
    return (
        days.withColumn("last_day", F.when(stays_open, next_day).otherwise(F.col("first_day")))
        .filter(F.col("lowest") < closing)
        .select(ACCOUNT, "first_day", "last_day")
        .join(with_id(created).select(ACCOUNT, USER).distinct(), ACCOUNT)
        .select(ACCOUNT, USER, "first_day", "last_day")
    )
