"""Running the look-back load whenever new source files have arrived."""

from __future__ import annotations

import datetime
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.time import day_of, moment
from tidemark.operators import incremental as inc
from tidemark.plans import stored
from tidemark.plans.loads import load_base, read_base
from tidemark.session import materialise_observed
from tidemark.sources import contracts

ARRIVAL = "arrival"


def load_on_arrival(spark: SparkSession, source_path: str, source_schema: T.StructType,
                    target: str, contract: T.StructType, key: str, checkpoint: str,
                    days: int = 3, late_table: str | None = None,
                    buckets: int | None = None) -> StreamingQuery:
    """Process everything that arrived since the last call, then stop.

    Delete+insert needs all rows of a key, so the days that the arrived rows fall on are read
    again from the source, from the first of them on; the filter reaches the scan. A batch
    without rows loads nothing. The load can be repeated, so a batch that is retried after a
    failure does no harm.

    Rows older than the look-back are missed, unless there is a `late_table`. It then takes them,
    with the number of the batch they arrived in, and their days are loaded anew as a whole. Its
    accounts are those to be rebuilt besides the batch's. The watermark is the look-back from the
    latest timestamp in the target, so it survives restarts with the table itself.
    """
    def load(arrived: DataFrame, batch: int) -> None:
        first = arrived.agg(F.min(day_of(key))).first()[0]
        if first is None:
            return
        source = spark.read.schema(source_schema).parquet(source_path)
        if late_table and stored.exists(spark, target):
            start = inc.look_back_start(read_base(spark, target, contract), key, days)
            if start is not None and first <= start.date():
                _take_late(spark, arrived.filter(F.col(key) < moment(start)), source, target,
                           contract, key, late_table, batch)
        affected = source.filter(F.col(key) >= F.lit(first).cast("timestamp_ntz"))
        load_base(spark, affected, target, contract, key, days, buckets)

    arrivals = spark.readStream.schema(source_schema).parquet(source_path)
    return (
        arrivals.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _take_late(spark: SparkSession, late: DataFrame, source: DataFrame, target: str,
               contract: T.StructType, key: str, late_table: str, batch: int) -> None:
    """Loads the days of late rows anew and adds the rows to the late table, once per batch."""
    rows, seen = materialise_observed(
        contracts.conform(late, contract).withColumn(ARRIVAL, F.lit(batch).cast("bigint")),
        "late_rows", days=F.collect_set(day_of(key)))
    if not seen["days"]:
        return
    reload_days(spark, source, target, contract, key, seen["days"])
    if stored.exists(spark, late_table):
        stored.overwrite(rows, late_table, [{ARRIVAL: str(batch)}])
    else:
        stored.create(rows, late_table, [ARRIVAL])


def reload_days(spark: SparkSession, source: DataFrame, target: str, contract: T.StructType,
                key: str, days: Collection[datetime.date]) -> None:
    """Puts the source's rows of some days in place of the target's; other days keep their files."""
    named = {str(d) for d in days}
    rows = contracts.conform(source, contract).withColumn(stored.EVENT_DATE, day_of(key))
    old = [p for p in stored.partitions(spark, target) if p[stored.EVENT_DATE] in named]
    keys = {k: "" for k in (old or stored.partitions(spark, target))[0]}
    # A day the target does not have yet is replaced too: nothing is there to be dropped.
    stored.overwrite(rows.filter(F.col(stored.EVENT_DATE).isin(sorted(days))), target,
                     old or [keys | {stored.EVENT_DATE: min(named)}])
