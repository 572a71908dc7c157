"""Hard negatives by an inverted multi-index: exact, and stopped by certificates.

Vectors become whole numbers and are split in two halves. Each half has a codebook, fitted by
k-means on at most `SAMPLE` rows with the smallest hashes of their ids; every row is put in the
cell of its two codewords. A half score of an anchor with any member of a codeword is at most
the score with the codeword plus the anchor's length times the codeword's radius over all rows.
A heap yields cells by the falling sum of both half bounds (the multi-sequence algorithm). The
search of an anchor stops when the next bound is below what it needs: its last positive found, or
for the negatives of each positive the last one found or the lower end of the window. So it
loses nothing, however poor the codebooks are; where bounds say little, as among random vectors
of many dimensions, it visits all cells.

Cells are packed in shelves of bounded size, a larger cell lies on several; anchors are packed
too. A task joins a shelf with some packs that visit it. Packs visit their best shelves first, a
growing number in each round, and take along what they have found, so that a later visit returns
only what is better: the rows returned grow with the anchors and the rounds, which are the
logarithm of the shelves. First all positives are found, then the negatives of their windows.
Every round is written down.

Rows with a null id or label, a null vector, or a component that is null, not finite or beyond
`LARGEST` take no part. Shorter vectors end in zeros. Of several rows with one id, that with the
smallest label, then vector, counts. Equal scores go by the smaller id. An anchor has fewer
positives or negatives if there are no more. Other columns do not matter. An empty table, or one
without anchors, gives an empty one.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import materialise

#: At most so many rows, and components, to fit the codebooks on.
SAMPLE, SAMPLE_COMPONENTS = 20_000, 1 << 23
#: Codewords of a half at most.
CODEWORDS = 64
#: Components on a shelf, anchors in a pack, packs that meet a shelf in one task.
SHELF_COMPONENTS, PACK, LANE = 1 << 20, 256, 64
#: Each round visits so many times the shelves of the last one.
GROWTH = 4
#: Components as numbers of up to 24 bits, so that scores of any usual length fit 63 bits.
LARGEST = float(1 << 24)
#: Rows scored at a time.
_CHUNK = 1024


def whole_numbers(embeddings: DataFrame, scale: int) -> DataFrame:
    """`vec_id`, `label`, `vector` (floor(scale * x), packed), `squares`: the rows that take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = [c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]
            batch = batch.filter(pa.array(known[0] & known[1] & known[2]))
            vectors = batch.column(2)
            ends = np.cumsum([0, *vectors.value_lengths().to_pylist()])
            values = vectors.flatten().to_numpy(zero_copy_only=False)  # nulls as not-a-number
            with np.errstate(over="ignore", invalid="ignore"):
                numbers = np.floor(scale * values)
                good = np.abs(numbers) <= LARGEST
            numbers = np.where(good, numbers, 0).astype(np.int64)
            bad = np.append(0, np.cumsum(~good))[ends]
            squares = np.append(0, np.cumsum(numbers * numbers))[ends]
            data = numbers.astype("<i4").tobytes()
            packed = [data[4 * a:4 * b] for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary()),
                 pa.array(np.diff(squares))], ["vec_id", "label", "vector", "squares"]
            ).filter(pa.array(np.diff(bad) == 0))

    chosen = embeddings.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"),
                               F.col("embedding").cast("array<double>"))
    rows = chosen.mapInArrow(run, "vec_id bigint, label bigint, vector binary, squares bigint")
    first = F.min(F.struct("label", "vector", "squares")).alias("row")
    return rows.groupBy("vec_id").agg(first).select("vec_id", "row.*")


def _matrix(column: list[bytes], width: int) -> np.ndarray:
    """Packed vectors as rows, with zeros behind the shorter ones."""
    data = b"".join(v.ljust(4 * width, b"\0") for v in column)
    return np.frombuffer(data, "<i4").reshape(len(column), width)


def _codebook(points: np.ndarray, words: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced points."""
    centres = points[np.linspace(0, len(points) - 1, words).astype(int)]
    for _ in range(rounds):
        nearest = _nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=words)[:, None]
        centres = np.where(counts > 0, sums / np.maximum(counts, 1), centres)
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(1) - 2 * points @ centres.T).argmin(1)


@dataclass(frozen=True)
class Index:
    """The codebooks and radii of the halves, and the shelf of each cell; all of bounded size.

    `cells` has for each cell (left word * words + right word) that holds rows its first shelf
    and the number of shelves it is spread over.
    """

    width: int
    centres: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    cells: dict[int, tuple[int, int]]
    shelves: int
    exact: str

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.width // 2
        return vectors[:, :half], vectors[:, half:]

    def bounds(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Per half and anchor: the highest score with a member of each codeword."""
        return [v @ c.T + np.sqrt((v ** 2).sum(1))[:, None] * r for v, c, r in zip(
            self.halves(vectors.astype(np.float64)), self.centres, self.radii)]


def _fit(rows: DataFrame, sample: int, codewords: int, shelf_rows: int | None) -> tuple:
    """The index without rows, and the rows with their cells, written down."""
    n, longest, squares = rows.agg(
        F.count(F.lit(1)), F.coalesce(F.max(F.length("vector")), F.lit(0)),
        F.coalesce(F.max("squares"), F.lit(0))).first()
    width = max(2, longest // 4)
    words = max(1, min(codewords, round(n ** 0.25)))
    bound = min(sample, max(words, SAMPLE_COMPONENTS // width))
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(bound).select("vector").toArrow()
    points = _matrix(chosen["vector"].to_pylist(), width).astype(np.float64)
    half = width // 2
    centres = tuple(_codebook(p, words) if n else np.zeros((words, p.shape[1]))
                    for p in (points[:, :half], points[:, half:]))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector").to_pylist(), width)
            cell, away = np.zeros(len(vectors), np.int64), []
            for part, c in zip((vectors[:, :half], vectors[:, half:]), centres):
                part = part.astype(np.float64)
                nearest = _nearest(part, c)
                cell = cell * words + nearest
                away.append(np.sqrt(((part - c[nearest]) ** 2).sum(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 pa.array([v.tobytes() for v in vectors], pa.binary()),
                 pa.array(cell), *map(pa.array, away)],
                ["vec_id", "label", "vector", "cell", "away_left", "away_right"])

    found = materialise(rows.mapInArrow(
        assign, "vec_id bigint, label bigint, vector binary, cell bigint, away_left double, "
                "away_right double"), "cells")
    # At most CODEWORDS ** 2 rows.
    counted = found.groupBy("cell").agg(
        F.count(F.lit(1)).alias("rows"), F.max("away_left"), F.max("away_right")).collect()
    radii, room = (np.zeros(words), np.zeros(words)), 0
    most = shelf_rows or max(64, SHELF_COMPONENTS // width)
    cells, shelf = {}, -1
    for cell, count, left, right in sorted(map(tuple, counted)):
        for r, word, away in zip(radii, divmod(cell, words), (left, right)):
            r[word] = max(r[word], away)
        if count > most:
            parts = -(-count // most)
            cells[cell], shelf, room = (shelf + 1, parts), shelf + parts, 0
        else:
            if count > room:
                shelf, room = shelf + 1, most
            cells[cell], room = (shelf, 1), room - count
    exact = "f4" if squares < 1 << 24 else "f8" if squares < 1 << 53 else "i8"
    index = Index(width, centres, radii, cells, shelf + 1, exact)
    places = rows.sparkSession.createDataFrame(
        [(cell, first, parts) for cell, (first, parts) in cells.items()],
        "cell bigint, first int, parts int")
    shelved = found.join(F.broadcast(places), "cell").select(
        "vec_id", "label", "vector", "cell", (F.col("first") + F.pmod(
            F.xxhash64("vec_id"), F.col("parts")).cast("int")).alias("shelf"))
    return index, materialise(shelved, "shelves")


def multi_sequence(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """All pairs of places in two falling sequences, by the falling sum of their values."""
    reached = [0] * len(left)  # of each place on the left, how many on the right came already
    heap = [(-(left[0] + right[0]), 0, 0)]
    while heap:
        total, i, j = heapq.heappop(heap)
        yield -total, i, j
        reached[i] = j + 1
        # A pair enters when the pairs before it on both sides came.
        if j + 1 < len(right) and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (-(left[i] + right[j + 1]), i, j + 1))
        if i + 1 < len(left) and reached[i + 1] == j:
            heapq.heappush(heap, (-(left[i + 1] + right[j]), i + 1, j))


class Shelf:
    """The rows of a shelf, sorted by cell, as arrays."""

    def __init__(self, index: Index, rows: pa.Table):
        cell = rows["cell"].to_numpy()
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        self.index = index
        self.vectors = _matrix(rows["vector"].to_pylist(), index.width)[order].astype(index.exact)
        self.ids, self.labels = (rows[c].to_numpy()[order] for c in ("vec_id", "label"))
        edges = np.append(np.flatnonzero(np.diff(cell, prepend=-1)), len(cell))
        words = len(index.radii[0])
        self.places = {divmod(int(cell[a]), words): (int(a), int(b))
                       for a, b in zip(edges, edges[1:])}
        self.words = [np.array(sorted(set(w))) for w in zip(*self.places)]

    def chunks(self, bounds: list[np.ndarray]) -> Iterator[tuple[float, list[tuple[int, int]]]]:
        """Ranges of rows in the order of their cells' bounds, with a bound on all from there on."""
        halves = [(w[o], b[w][o]) for w, b in zip(self.words, bounds)
                  for o in [np.argsort(-b[w], kind="stable")]]
        (left, left_bound), (right, right_bound) = halves
        ranges, rows, highest = [], 0, 0.0
        for bound, i, j in multi_sequence(left_bound.tolist(), right_bound.tolist()):
            place = self.places.get((int(left[i]), int(right[j])))
            if place is None:
                continue
            if not ranges:
                # Rounding of the bounds is far below one half, and scores are whole numbers.
                highest = bound + 0.5
            ranges.append(place)
            rows += place[1] - place[0]
            if rows >= _CHUNK:
                yield highest, ranges
                ranges, rows = [], 0
        if ranges:
            yield highest, ranges

    def search(self, anchor: dict, vector: np.ndarray, bounds: list[np.ndarray], keep: int,
               same: bool) -> Iterator[tuple[int, int, int]]:
        """(goal, id, score) of the best rows for each goal of an anchor.

        A goal is a range of scores, and the score from which on a row may be among its best.
        """
        goals = anchor["goals"]
        need = [max(g["low"], g["floor"]) for g in goals]
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in goals]
        for highest, ranges in self.chunks(bounds):
            if highest < min(need):
                break
            rows = np.concatenate([np.arange(a, b) for a, b in ranges])
            scores = (self.vectors[rows] @ vector).astype(np.int64)
            fits = (self.labels[rows] == anchor["label"]) == same
            fits &= (self.ids[rows] != anchor["vec_id"]) & (scores >= min(need))
            rows, scores = rows[fits], scores[fits]
            for g, goal in enumerate(goals):
                inside = (scores >= need[g]) & (scores <= goal["high"])
                if inside.any():
                    ids = np.concatenate([best[g][0], self.ids[rows[inside]]])
                    reached = np.concatenate([best[g][1], scores[inside]])
                    first = np.lexsort((ids, -reached))[:keep]
                    best[g] = ids[first], reached[first]
                    if len(first) == keep:
                        need[g] = max(need[g], int(reached[first[-1]]))
        for goal, (ids, reached) in zip(goals, best):
            for one, score in zip(ids.tolist(), reached.tolist()):
                yield goal["goal"], one, score


def _vectors_of(anchors: list[dict], index: Index) -> np.ndarray:
    return _matrix([a["vector"] for a in anchors], index.width)


def _planned(packs: DataFrame, index: Index, start: int, end: int) -> DataFrame:
    """(pack, shelf) of the shelves from place `start` to `end` in the order of a pack's bounds.

    Without those whose bound is below what every anchor of the pack needs.
    """
    cell = np.array(sorted(index.cells), dtype=np.int64)
    left, right = np.divmod(cell, len(index.radii[0]))
    spread = [(i, shelf) for i, c in enumerate(cell.tolist())
              for first, parts in [index.cells[c]] for shelf in range(first, first + parts)]
    of_cell, shelf = (np.array(x) for x in zip(*spread))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, anchors in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bounds = index.bounds(_vectors_of(anchors, index))
                need = np.array([min(max(g["low"], g["floor"]) for g in a["goals"])
                                 for a in anchors], dtype=np.float64)
                highest, margin = np.empty((2, len(cell)))
                for at in range(0, len(cell), _CHUNK):
                    some = slice(at, at + _CHUNK)
                    sums = bounds[0][:, left[some]] + bounds[1][:, right[some]]
                    highest[some] = sums.max(0)
                    margin[some] = (sums - need[:, None]).max(0)
                by_shelf = np.full((2, index.shelves), -np.inf)
                np.maximum.at(by_shelf[0], shelf, highest[of_cell])
                np.maximum.at(by_shelf[1], shelf, margin[of_cell])
                order = np.argsort(-by_shelf[0], kind="stable")[start:end]
                order = order[by_shelf[1][order] >= -0.5]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pack] * len(order), pa.int64()), pa.array(order, pa.int32())],
                    ["pack", "shelf"])

    return packs.select("pack", "anchors").mapInArrow(run, "pack bigint, shelf int")


def _best(index: Index, shelves: DataFrame, anchors: DataFrame, goals: DataFrame, keep: int,
          same: bool) -> DataFrame:
    """(anchor_id, goal, vec_id, score): the best `keep` rows for each goal of each anchor.

    `goals` has anchor_id, goal (a number) and the range of scores from low to high; `same` says
    whether the rows are of the anchor's label or of others.
    """
    schema = "anchor_id bigint, goal bigint, vec_id bigint, score bigint"
    names = [part.split()[0] for part in schema.split(", ")]
    lowest = F.lit(-1 << 62).cast("bigint")
    best = shelves.sparkSession.createDataFrame([], schema)

    def visit(rows: pa.Table, visits: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and visits.num_rows:
            shelf = Shelf(index, rows)
            for pack in visits["anchors"]:
                pack = pack.as_py()
                vectors = _vectors_of(pack, index)
                bounds = index.bounds(vectors)
                for i, anchor in enumerate(pack):
                    found += [(anchor["vec_id"], *one) for one in shelf.search(
                        anchor, vectors[i].astype(index.exact), [b[i] for b in bounds],
                        keep, same)]
        columns = zip(*found) if found else [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)

    start, count = 0, 1
    while start < index.shelves:
        floors = best.groupBy("anchor_id", "goal").agg(
            F.when(F.count(F.lit(1)) >= keep, F.min("score")).alias("floor"))
        wanted = goals.join(floors, ["anchor_id", "goal"], "left").groupBy("anchor_id").agg(
            F.collect_list(F.struct("goal", "low", "high", F.coalesce("floor", lowest)
                                    .alias("floor"))).alias("goals"))
        packs = materialise(
            anchors.join(wanted, anchors["vec_id"] == wanted["anchor_id"]).groupBy("pack").agg(
                F.collect_list(F.struct("vec_id", "label", "vector", "goals")).alias("anchors")),
            "packs")
        lanes = max(1, -(-packs.count() // LANE))
        plan = materialise(_planned(packs, index, start, start + count).withColumn(
            "lane", F.pmod(F.xxhash64("pack"), F.lit(lanes)).cast("int")), "visits")
        met = shelves.join(plan.select("shelf", "lane").distinct(), "shelf")
        # Other names, since both sides come from the plan.
        visits = plan.join(packs, "pack").select(
            F.col("shelf").alias("on"), F.col("lane").alias("by"), "anchors")
        found = met.groupBy("shelf", "lane").cogroup(
            visits.groupBy("on", "by")).applyInArrow(visit, schema)
        best = materialise(_first(best.unionByName(found), keep).drop("rank"), "best")
        start, count = start + count, count * GROWTH
    return best


def _first(found: DataFrame, keep: int) -> DataFrame:
    """The best rows of each goal with their `rank` from 1. A goal has some rows per visit."""
    order = Window.partitionBy("anchor_id", "goal").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def hard_negatives(embeddings: DataFrame, anchors: Column, positives: int = 5,
                   negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
                   sample: int = SAMPLE, codewords: int = CODEWORDS,
                   shelf_rows: int | None = None, pack: int = PACK) -> DataFrame:
    """Per anchor and positive: `rank`, `negative_id`, `positive_score` and `negative_score`.

    An anchor's positives are its best rows of the same label, its negatives the best of other
    labels whose score lies between `low` and `high` per cent of the positive's. `anchors` is a
    condition on the columns vec_id and label.
    """
    index, shelves = _fit(whole_numbers(embeddings, scale), sample, codewords, shelf_rows)
    chosen = shelves.filter(anchors)
    # Anchors of one shelf are near each other; a shelf may hold many packs of them.
    packs = chosen.groupBy("shelf").agg(
        F.ceil(F.count(F.lit(1)) / pack).alias("parts"))
    packed = materialise(chosen.join(packs, "shelf").select(
        "vec_id", "label", "vector",
        (F.col("shelf") * F.lit(1 << 32) + F.pmod(F.xxhash64("vec_id"), "parts")).alias("pack")),
        "anchors")
    all_scores = packed.select(
        F.col("vec_id").alias("anchor_id"), F.lit(0).cast("bigint").alias("goal"),
        F.lit(-1 << 62).cast("bigint").alias("low"), F.lit(1 << 62).cast("bigint").alias("high"))
    near = _best(index, shelves, packed, all_scores, positives, True)
    # The whole numbers from `low` to `high` per cent of the score, by hundreds and the rest.
    windows = near.filter("score >= 0").select(
        "anchor_id", F.col("vec_id").alias("goal"), F.col("score").alias("positive_score"),
        F.expr(f"score div 100 * {low} + (score % 100 * {low} + 99) div 100").alias("low"),
        F.expr(f"score div 100 * {high} + score % 100 * {high} div 100").alias("high")) \
        .filter("low <= high")
    found = _best(index, shelves, packed, windows.drop("positive_score"), negatives, False)
    return _first(found, negatives).join(
        windows.select("anchor_id", "goal", "positive_score"), ["anchor_id", "goal"]).select(
        "anchor_id", F.col("goal").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def relabelled(embeddings: DataFrame, divisor: int, labels: int) -> DataFrame:
    """The embeddings with the next label, round `labels`, where `divisor` divides the id."""
    moved = F.when(F.col("vec_id") % divisor == 0, (F.col("label") + 1) % labels)
    return embeddings.select("vec_id", "embedding", moved.otherwise(F.col("label")).alias("label"))
