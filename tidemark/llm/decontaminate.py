"""Benchmark passages in documents, found by spaced seeds.

A mask looks at some positions of a window of tokens and ignores the others. Hashes of the test
items' windows under each mask are joined with those of the documents, so a passage is found
although tokens at ignored positions were replaced. Around each hit, the common diagonal decides:
a passage is any run of MIN_TOKENS tokens (of a shorter item, all) in which MIN_AGREEMENT agree.
The masks meet every such run: a longer one holds one of at most 23 tokens, and for these the
tests go through all patterns of replaced tokens.

A document's windows are first looked up in a bitmap of the test hashes. The bitmap has a fixed
size whatever the number of items, so it can be broadcast; windows that pass are joined with the
test hashes exactly, so a full bitmap costs time but no result.

Tokens are lower-cased words without ASCII punctuation. Items of fewer than MIN_TOKENS
tokens are compared by windows of their own length, under masks of which one ignores whatever
tokens may be replaced. A word or two of an item stand in many documents that never saw the
benchmark, so an overlap of fewer than CONDEMNING_TOKENS tokens, which only an item that short can
have, is reported but does not condemn its document. Items without tokens, null texts and empty
texts match nothing. Items that share an item_id, or have none, are compared each by its own
tokens. Repeated rows are reported once per doc_id and item_id, where null is an id like others.
Other columns do not matter. Empty tables give an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import separators, splitmix, word_hashes
from tidemark.session import materialise

#: Positions looked at (1) and ignored (0).
MASKS = ("11011000101", "11100010011", "10110100011", "1110111")
MIN_TOKENS = 12
MIN_AGREEMENT = 0.8
CONDEMNING_TOKENS = 5
BITMAP_BITS = 1 << 24
MARGIN = 24
_MISMATCH = 4.0  # what a disagreeing token costs against an agreeing one: 1 in 5 may differ

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BETWEEN = separators(bytes(c for c in range(128) if not chr(c).isalnum()))


def token_hashes(text: str | None) -> np.ndarray:
    return word_hashes(text.lower().encode("utf-8"), _BETWEEN) if text else \
        np.zeros(0, dtype=np.uint64)


def window_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """A hash for each window of len(mask) tokens, over the positions the mask looks at."""
    count = len(tokens) - len(mask) + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(count, np.uint64(int(mask, 2) + (len(mask) << 32)))
    for offset, looked_at in enumerate(mask):
        if looked_at == "1":
            total = total * _STEP + tokens[offset:offset + count]
    return splitmix(total)


def masks_for(count: int) -> list[str]:
    """The masks for an item of `count` tokens: all of them, or some as long as a short item.

    Of a short item's 2k + 1 parts, k replaced tokens lie in k at most, and a mask ignores these.
    """
    if count >= MIN_TOKENS:
        return list(MASKS)
    replaced = int(count / (1 + _MISMATCH))
    parts = [i * (2 * replaced + 1) // count for i in range(count)]
    return ["".join("0" if part in ignored else "1" for part in parts)
            for ignored in itertools.combinations(range(2 * replaced + 1), replaced)]


def item_tokens(items: DataFrame) -> DataFrame:
    """`item`, `item_id`, `tokens` (hashes), one row per different item with tokens.

    `item` is a hash of the other two, which tells items with the same id, or none, apart.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [token_hashes(t.as_py()).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tokens, pa.list_(pa.int64()))],
                names=["item_id", "tokens"])

    chosen = items.select(F.col("item_id").cast("bigint").alias("item_id"),
                          F.col("text").cast("string").alias("text"))
    tokens = chosen.mapInArrow(run, "item_id bigint, tokens array<bigint>").filter(
        F.size("tokens") > 0).distinct()
    return tokens.select(F.xxhash64("item_id", "tokens").alias("item"), "item_id", "tokens")


def item_windows(tokens: DataFrame) -> DataFrame:
    """`hash`, `item`, `item_at`, `item_size` for every window of every item under its masks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, values in zip(batch.column(0).to_pylist(), batch.column(1)):
                row = values.values.to_numpy(zero_copy_only=False).view(np.uint64)
                for mask in masks_for(len(row)):
                    hashes = window_hashes(row, mask)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes.view(np.int64)),
                         pa.array([item] * len(hashes), pa.int64()),
                         pa.array(np.arange(len(hashes), dtype=np.int64)),
                         pa.array([len(row)] * len(hashes), pa.int64())],
                        names=["hash", "item", "item_at", "item_size"])

    return tokens.select("item", "tokens").mapInArrow(
        run, "hash bigint, item bigint, item_at bigint, item_size bigint")


def bitmap_of(windows: DataFrame) -> bytes:
    """A bit for the upper bits of each hash: BITMAP_BITS / 8 bytes, whatever the items."""
    shift = 64 - BITMAP_BITS.bit_length() + 1
    words = windows.select(F.shiftrightunsigned("hash", shift).alias("bit")).selectExpr(
        "int(shiftright(bit, 5)) AS word", "shiftleft(1L, int(bit % 32)) AS bits",
    ).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    filled = np.zeros(BITMAP_BITS // 32, dtype=np.uint32)
    # At most BITMAP_BITS / 32 rows come back, whatever the number of items.
    for row in words.toLocalIterator():
        filled[row["word"]] = row["bits"]
    return filled.tobytes()


def _regions(positions: np.ndarray, length: int, reach: int) -> list[tuple[int, int]]:
    """Stretches of a document that lie within `reach` of a hit, in order, not touching."""
    starts = np.maximum(positions - reach, 0)
    ends = np.minimum(positions + reach, length)
    new = np.r_[True, starts[1:] > np.maximum.accumulate(ends)[:-1]]
    firsts = np.flatnonzero(new)
    return list(zip(starts[firsts].tolist(), np.maximum.reduceat(ends, firsts).tolist()))


def suspicious_regions(docs: DataFrame, bitmap: bytes, masks: list[str], reach: int) -> DataFrame:
    """Stretches of documents around windows that the bitmap knows, with these windows."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    shift = np.uint64(64 - BITMAP_BITS.bit_length() + 1)

    def hits_of(tokens: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, found = [], []
        for mask in masks:
            hashes = window_hashes(tokens, mask)
            index = hashes >> shift
            known = np.flatnonzero(
                bits[index >> np.uint64(5)] >> (index & np.uint64(31)).astype(np.uint32) & 1)
            at.append(known)
            found.append(hashes[known])
        return np.concatenate(at), np.concatenate(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, dtype=np.uint32)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0), batch.column(1)):
                tokens = token_hashes(text.as_py())
                if not len(tokens):
                    continue
                at, found = hits_of(tokens, bits)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, found = at[order], found[order]
                for a, b in _regions(at, len(tokens), reach):
                    inside = (at >= a) & (at < b)
                    rows.append((doc.as_py(), a, tokens[a:b].view(np.int64),
                                 at[inside] - a, found[inside].view(np.int64)))
            if rows:
                ids, starts, tokens, at, found = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()),
                     pa.array(tokens, pa.list_(pa.int64())), pa.array(at, pa.list_(pa.int64())),
                     pa.array(found, pa.list_(pa.int64()))],
                    names=["doc_id", "region_at", "region", "window_at", "hash"])

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id bigint, region_at bigint, region array<bigint>, "
                                  "window_at array<bigint>, hash array<bigint>")


def best_run(region: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """Start in the region, length and agreeing tokens of the best run of one diagonal.

    Token i of the region lies against token i - shift of the item. An agreeing token counts 1,
    another one -_MISMATCH; the run with the largest sum is the best.
    """
    start, end = max(shift, 0), min(shift + len(item), len(region))
    if end <= start:
        return 0, 0, 0
    agree = region[start:end] == item[start - shift:end - shift]
    sums = np.r_[0.0, np.cumsum(np.where(agree, 1.0, -_MISMATCH))]
    lowest = np.minimum.accumulate(sums)
    stop = int(np.argmax(sums - lowest))
    first = int(np.argmin(sums[:stop + 1]))
    return start + first, stop - first, int(agree[first:stop].sum())


def longest_run(region: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """Like `best_run`, for the longest run whose sum is not negative."""
    start, end = max(shift, 0), min(shift + len(item), len(region))
    if end <= start:
        return 0, 0, 0
    agree = region[start:end] == item[start - shift:end - shift]
    sums = np.r_[0.0, np.cumsum(np.where(agree, 1.0, -_MISMATCH))]
    # The largest sum from each place on falls, so the last place with enough is searched for.
    highest = np.maximum.accumulate(sums[::-1])[::-1]
    stops = np.searchsorted(-highest, -sums, side="right") - 1
    first = int(np.argmax(stops - np.arange(len(sums))))
    stop = int(stops[first])
    return start + first, stop - first, int(agree[first:stop].sum())


def passage(region: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """The best run of a diagonal if it is a passage, else the longest one, else None."""
    enough = min(MIN_TOKENS, len(item))
    for run in (best_run, longest_run):
        start, length, agree = run(region, item, shift)
        if length >= enough and agree >= MIN_AGREEMENT * length:
            return start, length, agree
    return None


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in zip(*(batch.column(i) for i in range(6))):
            doc, item_id, shift, region_at = (v.as_py() for v in row[:4])
            region, item = (v.values.to_numpy(zero_copy_only=False) for v in row[4:])
            if found := passage(region, item, shift):
                start, length, agree = found
                rows.append((doc, item_id, region_at + start, length, agree))
        columns = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns],
            names=["doc_id", "item_id", "first_token", "n_tokens", "n_equal"])


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """`doc_id`, `item_id` and an overlap of the two, for contaminated documents only.

    Of several overlaps, it is the one in which most tokens agree.
    `first_token` is where it starts in the document, `n_tokens` its length, `n_equal` how many
    of its tokens agree.
    """
    tokens = materialise(item_tokens(items), "item_tokens")
    windows = materialise(item_windows(tokens), "item_windows")
    shorter = [r[0] for r in tokens.filter(F.size("tokens") < MIN_TOKENS)
               .select(F.size("tokens")).distinct().collect()]  # fewer than MIN_TOKENS lengths
    masks = list(MASKS) + [mask for n in sorted(shorter) for mask in masks_for(n)]
    regions = materialise(
        suspicious_regions(docs, bitmap_of(windows), masks, len(MASKS[0]) + MARGIN)
        .withColumn("region_id", F.monotonically_increasing_id()), "regions")
    hits = regions.select("region_id", F.explode(F.arrays_zip("window_at", "hash")).alias("w")) \
        .select("region_id", "w.window_at", "w.hash")
    found = hits.join(windows, "hash").select(
        "region_id", "item", "item_size",
        (F.col("window_at") - F.col("item_at")).alias("shift")).distinct()
    # Of a region, a pair takes along no more than what lies against the item.
    first = F.greatest("shift", F.lit(0))
    against = F.slice("region", first.cast("int") + 1,
                      (F.col("item_size") + F.least("shift", F.lit(0))).cast("int"))
    pairs = found.join(
        regions.select("region_id", "doc_id", "region_at", "region"), "region_id").select(
        "doc_id", "item", F.least("shift", F.lit(0)).alias("shift"),
        (F.col("region_at") + first).alias("region_at"), against.alias("region"))
    checked = pairs.join(tokens, "item").select(
        "doc_id", "item_id", "shift", "region_at", "region", "tokens") \
        .mapInArrow(_verified, "doc_id bigint, item_id bigint, first_token bigint, "
                               "n_tokens bigint, n_equal bigint")
    best = F.max(F.struct("n_equal", (-F.col("n_tokens")).alias("l"),
                          (-F.col("first_token")).alias("f"))).alias("best")
    return checked.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("best.f")).alias("first_token"),
        (-F.col("best.l")).alias("n_tokens"), F.col("best.n_equal").alias("n_equal"))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document with an overlap: its best one, and all items it overlaps with.

    `n_items` and `items` (ids in order, comma-joined, `-` for null) tell which these are,
    `item_id`, `first_token`, `n_tokens` and `n_equal` are those of the overlap in which most
    tokens agree, the shorter, earlier and smaller id of several, and `condemned` says whether
    any overlap is long enough to condemn the document.
    """
    named = F.struct(F.col("item_id").isNotNull().alias("known"), "item_id")
    best = F.max(F.struct(
        "n_equal", (-F.col("n_tokens")).alias("l"), (-F.col("first_token")).alias("f"),
        (-F.col("item_id")).alias("i"))).alias("best")
    ids = F.transform(F.array_sort(F.collect_set(named)), lambda one: F.coalesce(
        one["item_id"].cast("string"), F.lit("-")))
    return overlaps(docs, items).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.array_join(ids, ",").alias("items"), best,
        F.bool_or(F.col("n_tokens") >= CONDEMNING_TOKENS).alias("condemned")).select(
        "doc_id", "n_items", "items", (-F.col("best.i")).alias("item_id"),
        (-F.col("best.f")).alias("first_token"), (-F.col("best.l")).alias("n_tokens"),
        F.col("best.n_equal").alias("n_equal"), "condemned")
