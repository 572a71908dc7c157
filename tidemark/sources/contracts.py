"""Typed contracts of the source tables and of the published tables.

A contract is a StructType whose fields carry their description as `comment` metadata, so a
table saved from a conformed DataFrame keeps the column comments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark import columns as c

TIMESTAMP = T.TimestampNTZType()


class SchemaMismatch(ValueError):
    """The columns of a table differ from what the reader or writer expects."""


def _field(name: str, dtype: T.DataType, comment: str) -> T.StructField:
    return T.StructField(name, dtype, True, {"comment": comment})


ACCOUNT_CREATED = T.StructType([
    _field(c.ACCOUNT, T.StringType(), "account identifier, hashed upstream; one row each"),
    _field(c.USER, T.StringType(), "identifier of the owning user, hashed upstream"),
    _field(c.ACCOUNT_TYPE, T.StringType(), "product the account belongs to"),
    _field(c.CREATED, TIMESTAMP, "when the account was opened (UTC)"),
])

ACCOUNT_CLOSED = T.StructType([
    _field(c.ACCOUNT, T.StringType(), "account that was closed"),
    _field(c.CLOSED, TIMESTAMP, "when the closure was recorded (UTC)"),
])

ACCOUNT_REOPENED = T.StructType([
    _field(c.ACCOUNT, T.StringType(), "account that was reopened"),
    _field(c.REOPENED, TIMESTAMP, "when the reopening was recorded (UTC)"),
])

ACCOUNT_TRANSACTIONS = T.StructType([
    _field(c.ACCOUNT, T.StringType(), "account the transactions belong to"),
    _field(c.TX_COUNT, T.LongType(), "number of transactions of the account on the day"),
    _field(c.TX_DATE, TIMESTAMP, "day of the transactions (UTC midnight)"),
])

UNIFIED_ACCOUNTS = T.StructType([
    _field(c.ACCOUNT, T.StringType(), "account identifier"),
    _field(c.USER, T.StringType(), "user who owns the account"),
    _field(c.ACCOUNT_TYPE, T.StringType(), "product the account belongs to"),
    _field(c.STATUS, T.StringType(), "open, reopened or closed, per kept closure"),
    _field(c.CREATED, TIMESTAMP, "when the account was opened"),
    _field(c.CLOSED, TIMESTAMP, "the kept closure of this row; NULL if never closed"),
    _field(c.REOPENED, TIMESTAMP, "first reopening after the closure; NULL if none"),
    _field(c.TOTAL, T.LongType(), "lifetime transactions of the account, repeated per row"),
    _field(c.FLAG, T.LongType(), "1 if several closures are kept and one was never reopened"),
])

ACTIVE_USER_RATE = T.StructType([
    _field(c.CALC_DATE, T.DateType(), "day the rate is computed for"),
    _field("active_users", T.LongType(), "open users with activity in the window"),
    _field("total_open_users", T.LongType(), "users with an open account on the day"),
    _field("seven_day_active_user_rate", T.DoubleType(), "active_users / total_open_users"),
])


def missing_columns(df: DataFrame, contract: T.StructType) -> list[str]:
    """Columns the contract names and `df` lacks. Reads the schema only, runs no job."""
    present = set(df.columns)
    return [name for name in contract.fieldNames() if name not in present]


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project `df` to the contract: its columns, in its order, cast to its types.

    Extra source columns are dropped; missing ones raise.
    """
    missing = missing_columns(df, contract)
    if missing:
        raise SchemaMismatch(f"missing columns: {', '.join(missing)}")
    zoned = [f.name for f in df.schema.fields
             if isinstance(f.dataType, T.TimestampType) and f.name in contract.fieldNames()]
    if zoned and df.sparkSession.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC"):
        raise SchemaMismatch(f"zoned timestamps {zoned} need spark.sql.session.timeZone=UTC")
    return df.select([
        F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata)
        for f in contract.fields
    ])


def require_same_columns(incoming: DataFrame, target: T.StructType) -> None:
    """Raise unless `incoming` has exactly the names and types of `target`, order aside."""
    have = {f.name: f.dataType for f in incoming.schema.fields}
    want = {f.name: f.dataType for f in target.fields}
    if have != want:
        differing = sorted(n for n in have.keys() | want.keys() if have.get(n) != want.get(n))
        raise SchemaMismatch(f"columns differ from the target: {', '.join(differing)}")
