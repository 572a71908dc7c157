"""Small account tables written down by hand or drawn at random."""

from __future__ import annotations

import datetime
import random

import duckdb
import pyarrow as pa

from tidemark.sources import contracts
from tidemark.sources.tables import AccountTables

SCHEMAS = {
    "account_created": contracts.ACCOUNT_CREATED,
    "account_closed": contracts.ACCOUNT_CLOSED,
    "account_reopened": contracts.ACCOUNT_REOPENED,
    "account_transactions": contracts.ACCOUNT_TRANSACTIONS,
}

ARROW = {
    "account_created": [("account_id_hashed", pa.string()), ("user_id_hashed", pa.string()),
                        ("account_type", pa.string()), ("created_ts", pa.timestamp("us"))],
    "account_closed": [("account_id_hashed", pa.string()), ("closed_ts", pa.timestamp("us"))],
    "account_reopened": [("account_id_hashed", pa.string()), ("reopened_ts", pa.timestamp("us"))],
    "account_transactions": [("account_id_hashed", pa.string()), ("transactions_num", pa.int64()),
                             ("date", pa.timestamp("us"))],
}


def ts(text: str | None) -> datetime.datetime | None:
    """'5 10:30' is 10:30 on 5 January 2024; '5' is its midnight."""
    if text is None:
        return None
    day, _, clock = text.partition(" ")
    base = datetime.datetime(2024, 1, 1) + datetime.timedelta(days=int(day) - 1)
    if clock:
        t = datetime.time.fromisoformat(clock)
        base = datetime.datetime.combine(base.date(), t)
    return base


def spark_tables(spark, rows: dict[str, list[tuple]]) -> AccountTables:
    frames = [spark.createDataFrame(rows.get(name, []), schema) for name, schema in SCHEMAS.items()]
    return AccountTables(*frames)


def duck_tables(rows: dict[str, list[tuple]]) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name, columns in ARROW.items():
        values = rows.get(name, [])
        table = pa.table({n: pa.array([r[i] for r in values], t)
                          for i, (n, t) in enumerate(columns)})
        connection.register(name, table)
    return connection


def written(*, created=(), closed=(), reopened=(), transactions=()) -> dict[str, list[tuple]]:
    """Rows with timestamps given as text for `ts`."""
    return {
        "account_created": [(a, u, k, ts(t)) for a, u, k, t in created],
        "account_closed": [(a, ts(t)) for a, t in closed],
        "account_reopened": [(a, ts(t)) for a, t in reopened],
        "account_transactions": [(a, n, ts(t)) for a, n, t in transactions],
    }


def drawn(seed: int, accounts: int = 150, hot_share: float = 0.0,
          shared_ids: bool = False) -> dict[str, list[tuple]]:
    """Random tables with ties, copies, NULLs, orphans and events before creation.

    With `hot_share` that part of all events belongs to one account, and that part of the
    accounts to one user. With `shared_ids` some account ids occur under two users.
    """
    r = random.Random(seed)
    start = datetime.datetime(2024, 1, 1)

    def moment() -> datetime.datetime:
        # A coarse grid makes equal timestamps and busy minutes common.
        if r.random() < 0.5:
            return start + datetime.timedelta(hours=r.randrange(24 * 40))
        return start + datetime.timedelta(
            days=r.randrange(40), minutes=r.choice([599, 600, 601]), seconds=r.randrange(60),
            microseconds=r.choice([0, 1, 999_999]))

    def account() -> str | None:
        if r.random() < hot_share:
            return "a0"
        if r.random() < 0.01:
            return None
        return f"a{r.randrange(accounts + 10)}"

    def sometimes_null(value, chance=0.02):
        return None if r.random() < chance else value

    created = []
    for i in range(accounts):
        user = "u0" if r.random() < hot_share else f"u{r.randrange(accounts // 3)}"
        kind = sometimes_null(r.choice(["uk_retail", "uk_retail_pot", "uk_retail_joint"]))
        row = (f"a{i}", sometimes_null(user), kind, sometimes_null(moment()))
        created.append(row)
        if r.random() < 0.05:
            created.append(row)
        if shared_ids and r.random() < 0.2:
            created.append((f"a{i}", f"u{r.randrange(accounts // 3)}", kind, moment()))
    closed = [(account(), sometimes_null(moment(), 0.01)) for _ in range(accounts * 3)]
    reopened = [(account(), sometimes_null(moment(), 0.01)) for _ in range(accounts * 4)]
    closed += r.choices(closed, k=accounts // 3)
    reopened += r.choices(reopened, k=accounts // 3)
    midnight = datetime.time()
    transactions = [
        (account(), r.randrange(4), sometimes_null(
            datetime.datetime.combine(moment().date(), midnight), 0.01))
        for _ in range(accounts * 3)
    ]
    return {"account_created": created, "account_closed": closed, "account_reopened": reopened,
            "account_transactions": transactions}
