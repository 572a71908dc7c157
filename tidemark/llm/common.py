"""Small helpers the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SPACE = " \t\n\x0b\f\r"
#: Java and DuckDB both read this class: space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
#: A table of hosts, sources or languages up to this many rows is broadcast, a larger one joined.
BROADCAST_ROWS = 100_000


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def join_small(facts: DataFrame, small: DataFrame, key: str, rows: int) -> DataFrame:
    """Null-safe left join of many rows to a table of `rows` counted rows, unique by `key`.

    Up to BROADCAST_ROWS the table is broadcast; beyond, Spark chooses, and adaptive execution
    splits a hot key. The rows are the same either way.
    """
    right = small.withColumnRenamed(key, "_small_key")
    if rows <= BROADCAST_ROWS:
        right = F.broadcast(right)
    joined = facts.join(right, facts[key].eqNullSafe(right["_small_key"]), "left")
    return joined.drop("_small_key")


def quoted(name: str) -> Column:
    """The column of this very name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """All columns as one struct `row`, which no name of theirs can clash with, and some beside it.

    `unpacked` gives the rows back as they were.
    """
    return docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), *map(quoted, needed))


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


def row_keys(docs: DataFrame, *needed: str) -> DataFrame:
    """`packed`, with 128 bits of hash of the whole row in `key` and `key_rest`.

    Equal rows share them, others do not, NULLs counting with their place.
    """
    parts = [part for c in docs.columns for part in (quoted(c).isNull(), quoted(c))]
    hashes = [F.xxhash64(F.lit(seed), *parts).alias(name)
              for seed, name in (("row", "key"), ("rest", "key_rest"))]
    return docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), *hashes,
                       *map(quoted, needed))


def free_name(name: str, taken: list[str]) -> str:
    """`name`, or with the first number from 2 on that makes it none of those taken."""
    used, n, free = {t.lower() for t in taken}, 1, name
    while free.lower() in used:
        n += 1
        free = f"{name}_{n}"
    return free


def hex16(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def running_sums(column: str, chunk: int = 64) -> Column:
    """For each number of an array column, the sum of those before it.

    Sums of whole chunks are taken first, so an array of n numbers costs n * chunk steps.
    """
    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)

    at = F.col(column)
    chunks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(at) - 1, F.lit(0)), F.lit(chunk)),
        lambda k: total(F.slice(at, k + 1, chunk)))
    # One entry per chunk: its own sums of numbers before it, and what came before the chunk.
    return F.flatten(F.transform(
        F.aggregate(chunks, F.struct(F.lit(0).cast("bigint").alias("sum"),
                                     F.array().cast("array<bigint>").alias("all")),
                    lambda s, c: F.struct((s["sum"] + c).alias("sum"),
                                          F.concat(s["all"], F.array(s["sum"])).alias("all")),
                    lambda s: s["all"]),
        lambda before, k: F.transform(
            F.slice(at, k * chunk + 1, chunk),
            lambda _, i: before + total(F.slice(at, k * chunk + 1, i)))))


def utf8(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of each string of an Arrow column, one at a time."""
    for value in column:
        yield value.as_buffer().to_pybytes() if value.is_valid else None


def splitmix(x: np.ndarray) -> np.ndarray:
    """The finalising steps of the SplitMix64 generator: spreads every bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_PIECE = 1 << 20


def _powers(base: int) -> np.ndarray:
    powers = np.full(_PIECE + 1, np.uint64(base), dtype=np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


_UP: np.ndarray | None = None
_DOWN: np.ndarray | None = None


def _hash_piece(data: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of up to _PIECE bytes, and their last two bytes, the last one high.

    The hashes are polynomials in the bytes, taken from prefix sums.
    """
    global _UP, _DOWN
    if _UP is None:
        _UP, _DOWN = _powers(_BASE), _powers(_INVERSE)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~separator[data]
    edge = np.flatnonzero(np.diff(inside))
    starts, ends = edge[0::2], edge[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[:len(data)], out=sums[1:])
    poly = (sums[ends] - sums[starts]) * _DOWN[starts]
    sizes = ends - starts
    hashes = splitmix(poly + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    before = np.where(sizes > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.uint16)
    return hashes, (data[ends - 1].astype(np.uint16) << 8) | before


def words_of(data: bytes, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes and last two bytes of the words of a text; `separator` marks bytes between.

    Long texts are hashed piece by piece, cut between words, so that memory stays bounded; a
    word longer than a piece is hashed by the hashes of its pieces.
    """
    array = np.frombuffer(data, dtype=np.uint8)
    if len(array) <= _PIECE:
        return _hash_piece(array, separator)
    parts, at = [], 0
    while at < len(array):
        end = min(at + _PIECE, len(array))
        if end < len(array):
            gaps = np.flatnonzero(separator[array[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:  # one word longer than a piece
                rest = np.flatnonzero(separator[array[end:]])
                end = end + int(rest[0]) if len(rest) else len(array)
                parts.append(_long_word(array[at:end]))
                at = end
                continue
        parts.append(_hash_piece(array[at:end], separator))
        at = end
    return tuple(np.concatenate(x) for x in zip(*parts))


def word_hashes(data: bytes, separator: np.ndarray) -> np.ndarray:
    return words_of(data, separator)[0]


def _long_word(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    value, nothing = np.full(1, np.uint64(len(data))), np.zeros(256, dtype=bool)
    for at in range(0, len(data), _PIECE):
        hashes, tail = _hash_piece(data[at:at + _PIECE], nothing)
        value = splitmix(value + hashes)
    return value, tail


def separators(characters: bytes) -> np.ndarray:
    mask = np.zeros(256, dtype=bool)
    mask[np.frombuffer(characters, dtype=np.uint8)] = True
    return mask


BLANKS = separators(SPACE.encode())


def _folding() -> np.ndarray:
    """Bytes as 64 symbols; 0 is kept for the borders of a text."""
    fold = np.full(256, 63, dtype=np.uint8)
    for k in range(26):
        fold[ord("a") + k] = 2 + k
        fold[ord("A") + k] = 28 + k
    classes = [b" \t\n\r\x0b\x0c", b"0123456789", b".", b",", b"'\"`", b";:!?()-",
               b"#$%&*|<>@^~=+{}[]/\\_"]
    for symbol, members in zip([1, 54, 55, 56, 57, 58, 59], classes):
        fold[np.frombuffer(members, dtype=np.uint8)] = symbol
    # Other scripts share the symbols, nearly one for each byte, so that their letters stay apart.
    for k in range(0x40):
        fold[0x80 + k] = 1 + k % 62
        fold[0xC0 + k] = 1 + (11 * k + 5) % 62
    return fold


FOLD = _folding()
