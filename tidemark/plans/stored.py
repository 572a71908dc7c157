"""Catalog tables that hold the results, written by Spark's own writers.

A table is created with its rows in one statement, so an interrupted first run leaves none.
Later runs overwrite the partitions they hold rows of (dynamic partition overwrite), from rows
that are written down first; all other partitions keep their files.

Tables that are cut by account, or by another column, have `BUCKET` as their last partition
column. The column and the number of buckets are properties of the table, given when it is
created. Tables that share them are cut alike, so what concerns some accounts is read from the
same buckets of all of them.
"""

from __future__ import annotations

import contextlib
import datetime
from collections.abc import Collection, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.columns import ACCOUNT
from tidemark.session import materialise_observed

EVENT_DATE = "event_date"
BUCKET = "bucket"
BUCKETS_PROPERTY, BY_PROPERTY = "bucket_count", "bucket_by"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def bucket_of(buckets: int, by: str = ACCOUNT) -> Column:
    """The bucket of a row's account, or of another column; NULL has one of its own."""
    return F.when(F.col(by).isNull(), F.lit(-1)).otherwise(
        F.pmod(F.xxhash64(by), F.lit(buckets)).cast("int"))


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def create(df: DataFrame, table: str, partitions: Collection[str] = (),
           buckets: int | None = None, by: str = ACCOUNT) -> None:
    """Creates the table with the rows of `df`, whose comments it keeps."""
    keys = [*partitions, *([BUCKET] if buckets else [])]
    if buckets:
        df = df.withColumn(BUCKET, bucket_of(buckets, by))
    # The hint lets adaptive execution put small partitions together and split large ones.
    writer = (df.hint("rebalance", *keys) if keys else df).writeTo(table).using("parquet")
    if buckets:
        writer = writer.tableProperty(BUCKETS_PROPERTY, str(buckets)).tableProperty(
            BY_PROPERTY, by)
    if keys:
        writer = writer.partitionedBy(*map(F.col, keys))
    writer.create()


def replace(df: DataFrame, table: str) -> None:
    """Puts `df`, which must not read the table, in place of the whole unpartitioned table."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def cut_of(spark: SparkSession, table: str) -> tuple[int, str] | None:
    """Into how many buckets the table is cut, and by which column; None if it is not."""
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if BUCKETS_PROPERTY not in properties:
        return None
    return int(properties[BUCKETS_PROPERTY]), properties[BY_PROPERTY]


def buckets_of(spark: SparkSession, table: str) -> int | None:
    cut = cut_of(spark, table)
    return cut[0] if cut else None


def partitions(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """The partitions as the catalog names them: a row per day and bucket, no files are read."""
    return [dict(part.split("=", 1) for part in r.partition.split("/"))
            for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def latest_day(spark: SparkSession, table: str) -> datetime.date | None:
    days = {p[EVENT_DATE] for p in partitions(spark, table)} - {NULL_PARTITION}
    return datetime.date.fromisoformat(max(days)) if days else None


@contextlib.contextmanager
def _dynamic(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def overwrite(df: DataFrame, table: str, replaced: list[dict[str, str]]) -> None:
    """Overwrites the partitions `df` holds rows of, and drops those of `replaced` it has none of.

    `df` has the table's columns but BUCKET, and may read the table: it is written down first,
    which also tells the partitions it has. All rows of a partition must be in it, or the
    partition not among the replaced ones.
    """
    if not replaced:
        return
    spark, keys = df.sparkSession, list(replaced[0])
    columns = spark.table(table).columns
    if BUCKET in keys:
        df = df.withColumn(BUCKET, bucket_of(*cut_of(spark, table)))
    places = F.collect_set(F.struct(*(
        F.coalesce(F.col(k).cast("string"), F.lit(NULL_PARTITION)) for k in keys)))
    rows, seen = materialise_observed(df.select(*columns), "overwriting", places=places)
    held = {tuple(r) for r in seen["places"]}
    with _dynamic(spark):
        rows.hint("rebalance", *keys).write.mode("overwrite").insertInto(table)
    for place in replaced:
        if tuple(place.values()) not in held:
            spec = ", ".join(f"{k} = {_literal(v)}" for k, v in place.items())
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def _literal(value: str) -> str:
    return "NULL" if value == NULL_PARTITION else f"'{value}'"


def places(buckets: Collection[int]) -> list[dict[str, str]]:
    """The partitions of a table that is cut into buckets only."""
    return [{BUCKET: str(b)} for b in buckets]
