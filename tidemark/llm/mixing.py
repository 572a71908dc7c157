"""Mixing sources to target weights.

Tokens are counted per source; each source's share of all tokens follows its weight, but no
source is repeated more than `max_repeats` times: what a stopped source leaves is shared again
by weight among the others until none is above its limit. A document is then emitted
floor(rate) times, and once more if a hash of the seed and the document, read as a number
between 0 and 1, is below the fraction of the rate.

Sources are ordered by code point, null last, and weights repeat in that order. A null text has
size 0; null is a source of its own. Repeated rows draw alike. Other columns do not matter to
`mixture` and are kept by `mixed`, whatever their names. An empty table, or one without any word, gives target 0 and
takes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import WORD, free_name, join_small, packed
from tidemark.session import materialise

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 7


def words_in(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)).cast("bigint"),
                      F.lit(0).cast("bigint"))


def _positions(sources: DataFrame) -> DataFrame:
    """Adds `position`, the rank of each source, from ranks in ranges and the ranges' sizes.

    The ranges are sorted apart, so no task sees all sources.
    """
    order = [F.col("source").asc_nulls_last()]
    dealt = materialise(
        sources.repartitionByRange(*order).withColumn("range", F.spark_partition_id()),
        "source_ranges")
    sizes = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("rows"))
    before = sizes.select("range", F.coalesce(
        F.sum("rows").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    return dealt.join(before, "range").select(
        "source", "source_size", (F.col("before") + inside - 1).alias("position"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS,
                   max_repeats: int = MAX_REPEATS) -> tuple[DataFrame, int]:
    """`source`, `source_size`, `target` and `rate` from rows (source, size); and their number.

    A source is stopped if its limit is below level * weight. Each round sets the level from
    what the sources not yet stopped share, so it only rises, and ends when none is stopped anew.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)),
                          (F.col("position") % len(weights) + 1).cast("int"))
    limit = (F.col("source_size") * max_repeats).cast("double")
    table = materialise(
        _positions(sums).select("source", "source_size", weight.alias("weight"),
                                limit.alias("limit")), "sources")
    total, rows = table.agg(F.sum("source_size"), F.count(F.lit(1))).first()
    total = float(total or 0)
    level, stopped = 0.0, -1
    while True:
        above = F.col("limit") < F.col("weight") * level
        count, fixed, shares = table.agg(
            F.count_if(above), F.sum(F.when(above, F.col("limit"))),
            F.sum(F.when(~above, F.col("weight")))).first()
        if not shares or count == stopped:
            break
        stopped, level = count, (total - (fixed or 0.0)) / shares
    target = F.least(F.col("limit"), F.col("weight") * level)
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return table.select("source", "source_size", target.alias("target"), rate.alias("rate")), rows


def copies(rate: Column, seed: int, *identity: Column) -> Column:
    """floor(rate), plus one if the hash of `identity` falls below the fraction."""
    # The upper 52 bits of the hash as a number from 0 to 1.
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *identity), 12) / F.lit(float(1 << 52))
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("bigint")


def _rated(docs: DataFrame, rest: list[str], weights: tuple, max_repeats: int,
           seed: int) -> DataFrame:
    """`size`, `copies`, `source_size`, `target`, and the columns `rest` of the documents.

    The documents have the columns doc_id, text and source, and none of the names above.
    """
    sized = docs.withColumns({"size": words_in(F.col("text")),
                              "source": F.col("source").cast("string")})
    targets, rows = source_targets(sized.select("source", "size"), weights, max_repeats)
    joined = join_small(sized, targets, "source", rows)
    draw = copies(F.col("rate"), seed, F.col("doc_id"), F.col("text"))
    return joined.select(
        "size", "source_size", "target",
        F.least(draw, F.lit(max_repeats).cast("bigint")).alias("copies"), *rest)


def mixture(docs: DataFrame, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS,
            seed: int = SEED) -> DataFrame:
    """Per row: `doc_id`, `size`, `source_size`, `target`, `copies`, `taken` (size * copies)."""
    rated = _rated(docs.select("doc_id", "text", "source"), ["doc_id"], weights, max_repeats, seed)
    return rated.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS,
          seed: int = SEED) -> DataFrame:
    """`docs` with every row as often as the mix takes it, and `copy` counting from 0.

    Where `docs` has a column of that name, the number is called `copy_2`, and so on.
    """
    rated = _rated(packed(docs, "doc_id", "text", "source"), ["row"], weights, max_repeats, seed)
    return rated.filter("copies > 0").select(
        "row.*", F.explode(F.expr("sequence(0, int(copies) - 1)"))
        .alias(free_name("copy", docs.columns)))
