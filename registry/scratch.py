"""A scratch folder for registered queries in sessions that have none."""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@functools.cache
def _folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="scratch-")


def ensure_scratch(spark: SparkSession) -> None:
    """Sets a checkpoint folder where the session has none and all of it runs on this machine."""
    context = spark.sparkContext
    if (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
            or not context.master.startswith("local[")):
        return
    context.setCheckpointDir(_folder().name)


def with_scratch(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ensure_scratch(spark)
        return query(spark, folder)

    return run
