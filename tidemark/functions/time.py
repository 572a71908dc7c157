"""Calendar expressions that do not depend on the session time zone."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, functions as F


def moment(value: datetime.datetime) -> Column:
    """A naive datetime as a literal. By way of text, since a datetime literal is zoned."""
    return F.lit(value.isoformat(" ", "microseconds")).cast("timestamp_ntz")


def day_of(ts: str | Column) -> Column:
    return (F.col(ts) if isinstance(ts, str) else ts).cast("date")


def minute_of_day(ts: str | Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def second_of_day(ts: str | Column) -> Column:
    return minute_of_day(ts) * 60 + F.second(ts)
