"""Near-duplicates by SimHash fingerprints.

Fingerprints that differ in at most `max_bits` bits are linked. The 64 bits are cut into
`max_bits + 2` blocks; two linked fingerprints agree on at least two whole blocks, so they meet
under one of the keys made of two blocks. Under each key every pair is compared.

A key with more than GROUP_ROWS fingerprints is not compared as it stands: the bits outside it
are cut into blocks again, and its fingerprints move to longer keys by the same argument. Since
fingerprints are distinct, a key of 53 bits or more can hold no more than 2,048 of them, so this
ends, nothing is lost, and no task holds more than one group in memory.

Only distinct fingerprints take part: exact copies cost one row each. A task returns the links
of its groups as stars (each fingerprint to the smallest it reaches), never as all pairs.

Null and empty texts have fingerprint zero, which is linked like any other. Repeated rows keep
one row each. A null doc_id takes part, but a class is named by its smallest doc_id that is not
null (null if there is none). An empty table gives an empty table.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import hex16, utf8
from tidemark.llm.components import connected
from tidemark.session import materialise

SHINGLE_WORDS = 3
MAX_BITS = 3
GROUP_ROWS = 4096
SEED = 42
_SLAB = 1 << 15


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bit i is set if it is set in over half of the hashes of the shingles."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = min(shingle_words, len(words)) - 1
    cuts = zip(starts[:len(words) - last].tolist(), ends[last:].tolist())
    count = len(words) - last
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    while slab := [digest(joined[a:b], SEED) for a, b in itertools.islice(cuts, _SLAB)]:
        bits = np.unpackbits(np.array(slab, dtype="<u8").view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    set_bits = np.packbits((2 * ones > count).astype(np.uint8), bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """`doc_id` and `fp`, the fingerprint as a signed number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t, shingle_words) for t in utf8(batch.column(1))),
                                 dtype=np.int64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)],
                                             names=["doc_id", "fp"])

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id bigint, fp bigint")


def longer_masks(mask: int, max_bits: int) -> list[int]:
    """Masks that add two of `max_bits + 2` blocks of the bits that `mask` leaves free."""
    free = [i for i in range(64) if not mask >> i & 1]
    pieces = max_bits + 2
    blocks = [sum(1 << i for i in free[len(free) * k // pieces:len(free) * (k + 1) // pieces])
              for k in range(pieces)]
    return [mask | a | b for a, b in itertools.combinations(blocks, 2)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _roots(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """`labels` after joining the classes of left[i] and right[i], for every i."""
    while True:
        a, b = labels[left], labels[right]
        apart = a != b
        if not apart.any():
            return labels
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(jumped := labels[labels], labels):
            labels = jumped


def _stars(group: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups of adjacent rows: every linked row with the first of its class."""
    labels = np.arange(len(fp))
    alive = np.arange(len(fp) - 1)
    lag = 1
    while len(alive):
        alive = alive[alive + lag < len(fp)]
        alive = alive[group[alive] == group[alive + lag]]
        near = np.bitwise_count(fp[alive] ^ fp[alive + lag]) <= max_bits
        labels = _roots(labels, alive[near], alive[near] + lag)
        lag += 1
    moved = np.flatnonzero(labels != np.arange(len(fp)))
    return fp[moved], fp[labels[moved]]


def _compare(max_bits: int, group_rows: int):
    """Reads rows (mask, fp) sorted by key; returns links, and rows of groups that are too long.

    Output rows: mask 0 with a link in fp and other, or a longer mask with a fingerprint.
    """
    schema = pa.schema([("mask", pa.int64()), ("fp", pa.int64()), ("other", pa.int64())])

    def out(mask, fp, other) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.asarray(x).view(np.int64)) for x in (mask, fp, other)], schema=schema)

    def lengthen(mask: int, fp: np.ndarray) -> pa.RecordBatch:
        masks = np.array([m for m in longer_masks(mask, max_bits)], dtype=np.uint64)
        return out(np.repeat(masks, len(fp)), np.tile(fp, len(masks)),
                   np.zeros(len(fp) * len(masks), dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_mask = held_fp = np.zeros(0, dtype=np.uint64)
        flowing: tuple[int, int] | None = None  # the key of a long group that is passed on

        def finish(mask: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            key = fp & mask
            new = np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])]
            group = np.cumsum(new) - 1
            sizes = np.bincount(group)
            long = sizes > group_rows
            firsts = np.flatnonzero(new)
            for g in np.flatnonzero(long):
                rows = slice(firsts[g], firsts[g] + sizes[g])
                yield lengthen(int(mask[firsts[g]]), fp[rows])
            some = ((sizes > 1) & ~long)[group]
            if some.any():
                a, b = _stars(group[some], fp[some], max_bits)
                if len(a):
                    yield out(np.zeros(len(a), dtype=np.uint64), a, b)

        for batch in batches:
            mask = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            fp = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if flowing is not None:
                same = (mask == flowing[0]) & ((fp & mask) == flowing[1])
                if same.any():
                    yield lengthen(int(flowing[0]), fp[same])
                mask, fp = mask[~same], fp[~same]
                if not len(fp):
                    continue
                flowing = None
            mask, fp = np.concatenate([held_mask, mask]), np.concatenate([held_fp, fp])
            if not len(fp):
                continue
            key = fp & mask
            last = (mask == mask[-1]) & (key == key[-1])
            cut = len(fp) - int(last.sum())
            if cut:
                yield from finish(mask[:cut], fp[:cut])
            held_mask, held_fp = mask[cut:], fp[cut:]
            if len(held_fp) > group_rows:
                flowing = (held_mask[0], held_fp[0] & held_mask[0])
                yield lengthen(int(held_mask[0]), held_fp)
                held_mask = held_fp = np.zeros(0, dtype=np.uint64)
        if len(held_fp):
            yield from finish(held_mask, held_fp)

    return run


def linked(distinct: DataFrame, max_bits: int = MAX_BITS,
           group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links `a`, `b` that connect all of the distinct fingerprints `fp` that belong together."""
    start = F.array(*(F.lit(_signed(m)) for m in longer_masks(0, max_bits)))
    rows = distinct.select("fp", F.explode(start).alias("mask"))
    links = None
    while True:
        dealt = (
            rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
            .repartition("mask", "key").sortWithinPartitions("mask", "key", "fp"))
        found = materialise(
            dealt.select("mask", "fp").mapInArrow(
                _compare(max_bits, group_rows), "mask bigint, fp bigint, other bigint"),
            "fingerprint_links")
        new = found.filter("mask = 0").select(F.col("fp").alias("a"), F.col("other").alias("b"))
        links = new if links is None else links.unionByName(new)
        rows = found.filter("mask <> 0").select("fp", "mask")
        if rows.isEmpty():
            return links


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """`doc_id`, `fingerprint` in hex and `component_id`, one row per row of `docs`."""
    prints = materialise(fingerprints(docs, shingle_words), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    classes = connected(linked(distinct.select("fp"), max_bits))
    with_class = distinct.join(classes, distinct["fp"] == classes["node"], "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("class"))
    with_class = materialise(with_class, "fingerprint_classes")
    names = with_class.groupBy("class").agg(F.min("first_id").alias("component_id"))
    named = with_class.join(names, "class").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")
