"""The active-user rate kept from run to run.

Two tables hold what the rate is made of: the steps of every user, cut by user, and the changes
per calendar day, which are sums over the users. A run recomputes the steps of the users it
touched from the buckets of their accounts in the base tables, takes their old changes out of the
days, puts the new ones in, and writes only the buckets of those users. The cost follows the
touched users and their accounts; of the others nothing is read but the created rows, which tell
whose an account is. The rate itself is a running sum over one row per calendar day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import columns as c
from tidemark.columns import ACCOUNT, USER
from tidemark.operators import activity, incremental as inc
from tidemark.operators.closures import latest_closure_per_day
from tidemark.plans import loads, stored
from tidemark.plans.stored import BUCKET, EVENT_DATE
from tidemark.session import materialise
from tidemark.sources.tables import AccountTables

STEPS, DAYS, RATE = "rate_user_steps", "rate_days", "active_user_rate"
#: Buckets of the table of steps; choose them so that a run leaves most of them alone.
STEP_BUCKETS = 32


def _steps(t: AccountTables, window_days: int) -> DataFrame:
    spans = activity.open_spans_from_events(
        t.created, latest_closure_per_day(t.closed), t.reopened)
    return activity.user_steps(activity.open_intervals(spans), t.transactions, window_days)


def _per_day(steps: DataFrame) -> DataFrame:
    return activity.daily_changes(activity.with_levels(steps))


def _summed(changes: DataFrame) -> DataFrame:
    return changes.groupBy("day").agg(
        F.sum("d_open").alias("d_open"), F.sum("d_active").alias("d_active")).filter(
        (F.col("d_open") != 0) | (F.col("d_active") != 0))


def _touched_users(spark: SparkSession, database: str, touched: DataFrame) -> DataFrame:
    """Users who own a touched account, or owned one before."""
    contract, _ = loads.BASE_TABLES["account_created"]
    created = loads.read_base(spark, f"{database}.account_created", contract)
    owners = inc.of_accounts(created, touched.select(ACCOUNT).distinct()).select(USER)
    return owners.unionByName(touched.select(USER)).filter(F.col(USER).isNotNull()).distinct()


def _tables_of(spark: SparkSession, database: str, users: DataFrame) -> AccountTables:
    """The created rows of the users, and all events of their accounts."""
    contract, _ = loads.BASE_TABLES["account_created"]
    created = loads.read_base(spark, f"{database}.account_created", contract)
    owned = materialise(created.join(users, USER, "left_semi"), "created_of_users")
    accounts, held = loads.with_buckets(
        owned.select(ACCOUNT).filter(F.col(ACCOUNT).isNotNull()).distinct(), "accounts_of_users",
        stored.buckets_of(spark, f"{database}.account_created"))
    events = loads.read_bases(spark, database, held).map(
        lambda df: df.join(accounts, ACCOUNT, "left_semi"))
    return AccountTables(owned, events.closed, events.reopened, events.transactions)


def load_rate(spark: SparkSession, database: str, touched: DataFrame | None,
              window_days: int = 7, buckets: int = STEP_BUCKETS) -> DataFrame:
    """Bring the rate up to date with the base tables and return it.

    `touched` is what `loads.load_bases` returned for the run, None for the first one. The base
    tables must be cut into buckets. The window is that of the first run.
    """
    steps, days = f"{database}.{STEPS}", f"{database}.{DAYS}"
    if touched is None or not stored.exists(spark, steps):
        stored.create(_steps(loads.read_bases(spark, database), window_days), steps,
                      buckets=buckets, by=USER)
        changes = _summed(_per_day(spark.table(steps).drop(BUCKET)))
    else:
        users, held = loads.with_buckets(
            _touched_users(spark, database, touched), "touched_users",
            stored.buckets_of(spark, steps), USER)
        new = materialise(_steps(_tables_of(spark, database, users), window_days), "new_steps")
        stored_steps = spark.table(steps).filter(F.col(BUCKET).isin(held)).drop(BUCKET)
        old = stored_steps.join(users, USER, "left_semi")
        gone = _per_day(old).select(
            "day", (-F.col("d_open")).alias("d_open"), (-F.col("d_active")).alias("d_active"))
        changes = _summed(spark.table(days).unionByName(gone).unionByName(_per_day(new)))
        # Written down before the steps change, since it reads the old ones.
        changes = materialise(changes, "rate_days")
        kept = stored_steps.join(users, USER, "left_anti")
        stored.overwrite(kept.unionByName(new), steps, stored.places(held))
    stored.replace(changes, days)
    # The days with transactions are the partitions of their table; no file is opened for them.
    dates = spark.table(f"{database}.account_transactions").select(
        F.col(EVENT_DATE).alias("day")).distinct()
    rate = activity.rate_of_days(spark.table(days), dates)
    stored.replace(rate, f"{database}.{RATE}")
    return spark.table(f"{database}.{RATE}").select(
        c.CALC_DATE, "active_users", "total_open_users", "seven_day_active_user_rate")
