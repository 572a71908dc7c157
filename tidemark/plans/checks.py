"""The declared checks of the account tables and marts, run as a suite.

A check has a grade: pass while the failures stay at or below `warn_above`, warn beyond it,
error beyond `error_above` if one is set.

What a check costs depends on its kind. Rules on single rows and freshness are aggregates that a
`Watch` gathers while a table is written, or else one pass per table. All keys of a table are
counted together by grouping sets, in one shuffle. All children of a parent meet it in one
shuffle of their keys. Other rules bring a plan of their own. The counts of all of them are
summed by one last aggregate over one small row per check and task.
"""

from __future__ import annotations

import datetime
import functools
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidemark import columns as c
from tidemark.columns import ACCOUNT, CALC_DATE, CLOSED, CREATED, REOPENED, USER
from tidemark.functions.time import moment
from tidemark.operators import quality as q
from tidemark.sources import contracts

ACCOUNT_STATES = [c.CLOSED_STATE, c.OPEN, c.REOPENED_STATE]

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class RowCheck:
    """A rule on single rows. All row checks of a table share one pass over it."""

    name: str
    table: str
    failing: Column
    error_above: int | None = None
    warn_above: int = 0


@dataclass(frozen=True)
class KeyCheck:
    """A rule on the rows that share a key: not more than `most` that are `judged`, all if None.

    With `several` the rule is instead that they agree on that column, NULLs aside.
    """

    name: str
    table: str
    key: tuple[str, ...]
    judged: Column | None = None
    most: int = 1
    several: str | None = None
    error_above: int | None = None
    warn_above: int = 0

    def rows(self, df: DataFrame) -> DataFrame:
        """The failing keys, as the operators give them."""
        if self.several:
            return q.keys_with_several(df, *self.key, self.several)
        judged = df if self.judged is None else df.filter(self.judged)
        return judged.groupBy(*self.key).agg(F.count(F.lit(1)).alias("row_count")).filter(
            F.col("row_count") > self.most)


@dataclass(frozen=True)
class RelationCheck:
    """The rule that every key of a table that is not NULL occurs in the parent."""

    name: str
    table: str
    parent: str
    key: str = ACCOUNT
    error_above: int | None = None
    warn_above: int = 0


@dataclass(frozen=True)
class TableCheck:
    """A rule with a plan of its own: a function from the tables to failing rows."""

    name: str
    table: str
    failing_rows: Callable[[Tables], DataFrame]
    error_above: int | None = None
    warn_above: int = 0


@dataclass(frozen=True)
class FreshnessCheck:
    name: str
    table: str
    loaded_at: str
    warn_after: datetime.timedelta = datetime.timedelta(hours=8)
    error_above: int | None = None
    warn_above: int = 0


Check = RowCheck | KeyCheck | RelationCheck | TableCheck | FreshnessCheck


def not_null(table: str, column: str, error_above: int | None = None) -> RowCheck:
    return RowCheck(f"not_null_{table}_{column}", table, F.col(column).isNull(), error_above)


def expression_is_true(table: str, name: str, rule: Column) -> RowCheck:
    return RowCheck(f"expression_{table}_{name}", table, ~rule)


def unique(table: str, column: str) -> KeyCheck:
    return KeyCheck(f"unique_{table}_{column}", table, (column,), F.col(column).isNotNull())


def unique_combination(table: str, columns: list[str]) -> KeyCheck:
    return KeyCheck(f"unique_combination_{table}_{'_'.join(columns)}", table, tuple(columns))


def accepted_values(table: str, column: str, values: list[str]) -> KeyCheck:
    return KeyCheck(f"accepted_values_{table}_{column}", table, (column,),
                    ~F.col(column).isin(values), most=0)


def relationship(table: str, parent: str, key: str = ACCOUNT) -> RelationCheck:
    return RelationCheck(f"relationship_{table}_{parent}", table, parent, key)


def source_checks() -> list[Check]:
    """Checks declared on the four source tables."""
    return [
        not_null("account_created", ACCOUNT),
        unique("account_created", ACCOUNT),
        not_null("account_created", USER),
        not_null("account_created", c.ACCOUNT_TYPE, error_above=2),
        not_null("account_created", CREATED, error_above=0),
        not_null("account_reopened", ACCOUNT),
        relationship("account_reopened", "account_created"),
        not_null("account_reopened", REOPENED, error_above=0),
        not_null("account_closed", ACCOUNT),
        relationship("account_closed", "account_created"),
        not_null("account_closed", CLOSED, error_above=0),
        not_null("account_transactions", ACCOUNT),
        # Declared, though the table has a row per account and day: expect failures.
        unique("account_transactions", ACCOUNT),
        unique_combination("account_transactions", [ACCOUNT, c.TX_DATE]),
        relationship("account_transactions", "account_created"),
        expression_is_true("account_transactions", "not_negative", F.col(c.TX_COUNT) >= 0),
        not_null("account_transactions", c.TX_DATE, error_above=0),
        KeyCheck("one_user_per_account", "account_created", (ACCOUNT,), several=USER),
    ]


def freshness_checks() -> list[Check]:
    return [
        FreshnessCheck("freshness_account_created", "account_created", CREATED),
        FreshnessCheck("freshness_account_reopened", "account_reopened", REOPENED),
        FreshnessCheck("freshness_account_closed", "account_closed", CLOSED),
        FreshnessCheck("freshness_account_transactions", "account_transactions", c.TX_DATE),
    ]


def mart_checks() -> list[Check]:
    """Checks on the deduplicated closures and the two marts."""
    return [
        unique_combination("deduplicated_closures", [ACCOUNT, CLOSED]),
        unique_combination("unified_accounts", [ACCOUNT, CLOSED]),
        accepted_values("unified_accounts", c.STATUS, ACCOUNT_STATES),
        not_null("unified_accounts", ACCOUNT),
        not_null("unified_accounts", USER),
        not_null("unified_accounts", c.ACCOUNT_TYPE, error_above=2),
        not_null("unified_accounts", CREATED),
        # Declared, though accounts may never close or reopen: expect failures.
        not_null("unified_accounts", CLOSED),
        not_null("unified_accounts", REOPENED),
        not_null("unified_accounts", c.STATUS),
        expression_is_true("unified_accounts", "total_not_negative", F.col(c.TOTAL) >= 0),
        RowCheck("lifecycle_order", "unified_accounts",
                 (F.col(CLOSED) < F.col(CREATED)) | (F.col(REOPENED) < F.col(CLOSED))),
        TableCheck("totals_reconcile", "unified_accounts",
                   lambda t: q.total_mismatches(t["unified_accounts"], t["account_transactions"])),
        unique_combination("active_user_rate", [CALC_DATE]),
        *[not_null("active_user_rate", n) for n in contracts.ACTIVE_USER_RATE.fieldNames()],
    ]


DECLARED = {
    "account_created": contracts.ACCOUNT_CREATED,
    "account_reopened": contracts.ACCOUNT_REOPENED,
    "account_closed": contracts.ACCOUNT_CLOSED,
    "account_transactions": contracts.ACCOUNT_TRANSACTIONS,
}


def missing_columns(tables: Tables) -> dict[str, list[str]]:
    """Declared columns each source table lacks; empty lists are good. Runs no job."""
    return {name: contracts.missing_columns(tables[name], contract)
            for name, contract in DECLARED.items() if name in tables}


def grade(failures: Column, warn_above: Column, error_above: Column) -> Column:
    return (
        F.when(failures > error_above, "error").when(failures > warn_above, "warn")
        .otherwise("pass")
    )


def _one_pass(check: RowCheck | FreshnessCheck) -> Column:
    """The aggregate from which the check's failures follow."""
    if isinstance(check, RowCheck):
        return F.count_if(check.failing)
    return F.max(check.loaded_at)


class Watch:
    """Gathers what row and freshness checks need while their tables are written."""

    def __init__(self, checks: list[Check]):
        self._checks = [c for c in checks if isinstance(c, (RowCheck, FreshnessCheck))]
        self._seen: dict[str, Observation] = {}

    def over(self, table: str, rows: DataFrame) -> DataFrame:
        """The rows, to be written once: they are counted on their way."""
        own = [c for c in self._checks if c.table == table]
        if not own:
            return rows
        self._seen[table] = Observation()
        return rows.observe(self._seen[table], *[_one_pass(c).alias(c.name) for c in own])

    def seen(self) -> dict[str, object]:
        """What was gathered, by name of the check, once the tables are written."""
        return {name: value for o in self._seen.values() for name, value in o.get.items()}


def _failures_of(check: Check, found: Column, as_of: datetime.datetime | None) -> Column:
    """The number of failures from the aggregate of a row or freshness check."""
    if isinstance(check, RowCheck):
        return F.coalesce(found, F.lit(0)).cast("bigint")
    if as_of is None:
        raise ValueError("freshness checks need as_of")
    fresh = F.coalesce(found >= moment(as_of - check.warn_after), F.lit(False))
    return (~fresh).cast("bigint")


def _rows_of(counts: DataFrame, found: list[tuple[Check, Column]]) -> DataFrame:
    """(check_name, failures) from one row of counts."""
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c.name).alias("check_name"), n.cast("bigint").alias(q.FAILURES))
        for c, n in found])))


def _key_failures(df: DataFrame, checks: list[KeyCheck]) -> DataFrame:
    """A row (check_name, 1) per failing key: all keys of a table in one shuffle."""
    sets = list(dict.fromkeys(c.key for c in checks))
    names = list(dict.fromkeys(n for key in sets for n in key))
    flags = {f"judged_{i}": F.lit(True) if c.judged is None else F.coalesce(c.judged, F.lit(False))
             for i, c in enumerate(checks)}
    values = {f"value_{i}": F.col(c.several) for i, c in enumerate(checks) if c.several}
    rows = df.select(*names, *[v.alias(k) for k, v in (flags | values).items()])
    found = []
    for i, check in enumerate(checks):
        if check.several:
            found.append((F.min(f"value_{i}") < F.max(f"value_{i}")).alias(f"fails_{i}"))
        else:
            found.append((F.count_if(f"judged_{i}") > check.most).alias(f"fails_{i}"))
    grouped = rows.groupingSets([[F.col(n) for n in key] for key in sets],
                                *map(F.col, names)).agg(F.grouping_id().alias("of"), *found)

    def of(key: tuple[str, ...]) -> int:
        """The grouping id of a set: a bit for each name that is not in it."""
        return sum(1 << (len(names) - 1 - i) for i, n in enumerate(names) if n not in key)

    failing = F.filter(F.array(*[
        F.when((F.col("of") == of(c.key)) & F.col(f"fails_{i}"), F.lit(c.name))
        for i, c in enumerate(checks)]), lambda name: name.isNotNull())
    return grouped.select(F.explode(failing).alias("check_name"),
                          F.lit(1).cast("bigint").alias(q.FAILURES))


def _orphan_failures(tables: Tables, checks: list[RelationCheck]) -> DataFrame:
    """(check_name, failures) per key: all children of a parent in one shuffle."""
    (parent, key), = {(c.parent, c.key) for c in checks}
    orphans = q.orphaned_keys_of({c.name: tables[c.table] for c in checks}, tables[parent], key)
    return orphans.select(F.col("child").alias("check_name"),
                          F.col("row_count").alias(q.FAILURES))


def run_checks(tables: Tables, checks: list[Check], as_of: datetime.datetime | None = None,
               seen: Mapping[str, object] | None = None) -> DataFrame:
    """One row per check: name, table, failures and status.

    `seen` holds what a `Watch` gathered while tables were written; row and freshness checks
    without it take one pass per table. A freshness failure counts 1 and only warns.
    """
    seen = seen or {}
    spark = next(iter(tables.values())).sparkSession
    declared = spark.createDataFrame(
        [(c.name, c.table, c.warn_above, c.error_above) for c in checks],
        "check_name string, table_name string, warn_above bigint, error_above bigint")
    groups: dict[tuple, list[Check]] = {}
    for check in checks:
        kind = (RowCheck if isinstance(check, FreshnessCheck) else type(check))
        if check.name in seen:
            at = ("seen",)
        elif kind is RelationCheck:
            at = (kind, check.parent, check.key)
        elif kind is TableCheck:
            at = (kind, check.name)
        else:
            at = (kind, check.table)
        groups.setdefault(at, []).append(check)
    parts = []
    for (kind, *_), group in groups.items():
        df = tables[group[0].table] if group[0].table in tables else None
        if kind == "seen":
            kinds = [F.lit(seen[c.name]).cast("bigint" if isinstance(c, RowCheck)
                                              else "timestamp_ntz") for c in group]
            parts.append(_rows_of(spark.range(1), [
                (c, _failures_of(c, n, as_of)) for c, n in zip(group, kinds)]))
        elif kind is RowCheck:
            counts = df.agg(*[_one_pass(c).alias(f"n{i}") for i, c in enumerate(group)])
            parts.append(_rows_of(counts, [
                (c, _failures_of(c, F.col(f"n{i}"), as_of)) for i, c in enumerate(group)]))
        elif kind is KeyCheck:
            parts.append(_key_failures(df, group))
        elif kind is RelationCheck:
            parts.append(_orphan_failures(tables, group))
        else:
            (check,) = group
            parts.append(check.failing_rows(tables).select(
                F.lit(check.name).alias("check_name"),
                F.lit(1).cast("bigint").alias(q.FAILURES)))
    none = declared.select("check_name", F.lit(0).cast("bigint").alias(q.FAILURES))
    failures = functools.reduce(DataFrame.unionByName, [none, *parts]).groupBy("check_name").agg(
        F.sum(q.FAILURES).alias(q.FAILURES))
    return failures.join(F.broadcast(declared), "check_name").select(
        "check_name", "table_name", q.FAILURES,
        grade(F.col(q.FAILURES), F.col("warn_above"), F.col("error_above")).alias("status"))


def failing_rows(tables: Tables, check: RowCheck | KeyCheck | RelationCheck | TableCheck
                 ) -> DataFrame:
    """The rows a check fails on; for rules on keys the keys, with what is wrong with them."""
    if isinstance(check, TableCheck):
        return check.failing_rows(tables)
    if isinstance(check, RelationCheck):
        return q.orphaned_keys(tables[check.table], tables[check.parent], check.key)
    if isinstance(check, KeyCheck):
        return check.rows(tables[check.table])
    return tables[check.table].filter(check.failing)


def _tagged(df: DataFrame, checks: list[RowCheck]) -> DataFrame:
    """Failing rows of all the checks, once for each check a row fails."""
    failed = F.filter(F.array(*[F.when(check.failing, check.name) for check in checks]),
                      lambda name: name.isNotNull())
    return df.select("*", F.explode(failed).alias("check_name"))


def store_failures(spark: SparkSession, tables: Tables, checks: list[Check],
                   folder: str) -> dict[str, DataFrame]:
    """Write the failing rows of each check below `folder`; returns them as stored, by name.

    All row checks of a table share one pass over it and one table partitioned by check; each
    other check has a table of its own. A check that passes has no rows stored, which clears
    the failures of an earlier run.
    """
    stored = {}
    by_table: dict[str, list[RowCheck]] = {}
    for check in checks:
        if isinstance(check, RowCheck):
            by_table.setdefault(check.table, []).append(check)
        elif not isinstance(check, FreshnessCheck):
            failing = failing_rows(tables, check)
            failing.write.mode("overwrite").parquet(f"{folder}/{check.name}")
            stored[check.name] = spark.read.schema(failing.schema).parquet(
                f"{folder}/{check.name}")
    for table, group in by_table.items():
        path = f"{folder}/rows_of_{table}"
        tagged = _tagged(tables[table], group)
        tagged.write.mode("overwrite").partitionBy("check_name").parquet(path)
        rows = spark.read.schema(tagged.schema).parquet(path)
        for check in group:
            stored[check.name] = rows.filter(F.col("check_name") == check.name).drop("check_name")
    return stored


def column_report(tables: Tables) -> DataFrame:
    """For each declared column of the source tables: whether it is there, and its values.

    One pass per table; a missing column has no values.
    """
    parts = []
    for name, lacking in missing_columns(tables).items():
        declared = DECLARED[name].fieldNames()
        counts = tables[name].agg(*[
            (F.lit(0).cast("bigint") if n in lacking else F.count(n)).alias(n) for n in declared])
        parts.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(n).alias("column_name"),
                     F.lit(n not in lacking).alias("present"), F.col(n).alias("n_values"))
            for n in declared]))))
    return functools.reduce(DataFrame.unionByName, parts)
