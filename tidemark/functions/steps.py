"""Step functions over days, kept as rows (day, change of value).

An interval [first, last] of weight w is the two steps (first, +w) and (last + 1, -w); adding
up the steps in day order gives the total weight on each day. The cost follows the number of
intervals, not their length, and a key never has more steps than there are calendar days once
equal days are summed. That bounds every window below, however skewed the intervals are.
"""

from __future__ import annotations

from pyspark.sql import Column, Window as W, functions as F


def step_pair(first: Column, last: Column, **weights: Column) -> Column:
    """Array of the two steps of an interval; `last` NULL means without end.

    Each keyword names a change and gives its weight. The second step of an endless interval
    has a NULL day: filter it out.
    """
    return F.array(
        F.struct(first.alias("day"), *[w.alias(n) for n, w in weights.items()]),
        F.struct(F.date_add(last, 1).alias("day"), *[(-w).alias(n) for n, w in weights.items()]),
    )


def value_on_step(change: str, keys: list[str], day: str = "day") -> Column:
    """Value of the step function from this step's day on (one row per key and day).

    The value before the step is this one less the change.
    """
    window = W.partitionBy(*keys).orderBy(day)
    return F.sum(change).over(window.rowsBetween(W.unboundedPreceding, W.currentRow))
