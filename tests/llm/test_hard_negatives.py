"""Hard negatives against scores of all pairs, with indexes of many shapes."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, label bigint, embedding array<float>"


def expected(rows, every=5, low=30, high=90, positives=5, negatives=10):
    known = {}
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None:
            continue
        vector = [None if x is None else float(np.float32(x)) for x in vector]
        if any(x is None or not math.isfinite(x) or abs(256 * x) > 1 << 24 for x in vector):
            continue
        row = label, [math.floor(256 * x) for x in vector]
        if vec_id not in known or row < known[vec_id]:
            known[vec_id] = row

    def score(a, b):
        return sum(x * y for x, y in zip(known[a][1], known[b][1]))

    result = set()
    for a in known:
        if a % every:
            continue
        others = sorted(((-score(a, b), b) for b in known if b != a))
        same = [(-s, b) for s, b in others if known[b][0] == known[a][0]][:positives]
        for positive_score, positive in same:
            fits = [(-s, b) for s, b in others if known[b][0] != known[a][0]
                    and low * positive_score <= -100 * s <= high * positive_score]
            for rank, (s, b) in enumerate(fits[:negatives], 1):
                result.add((a, positive, rank, b, positive_score, s))
    return result


def found(spark, rows, schema=SCHEMA, parts=4, **options):
    table = spark.createDataFrame(rows, schema).repartition(parts)
    got = [tuple(r) for r in hn.hard_negatives(table, F.col("vec_id") % 5 == 0, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


def drawn(count, width, seed, spread=1.0, centres=6):
    """Clustered vectors with ties and copies."""
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(centres, width))
    rows = []
    for i in range(count):
        vector = middle[draw.integers(centres)] + spread * draw.normal(size=width)
        if i % 4 == 0:
            vector = np.round(vector)
        rows.append((i, int(draw.integers(4)), vector.astype(np.float32).tolist()))
    copies = [(count + i, r[1] ^ (i % 2), r[2]) for i, r in enumerate(rows[:count // 10])]
    return rows + copies


@pytest.mark.parametrize("width, spread, options", [
    (8, 0.2, {}),
    (8, 0.05, {"codewords": 3, "shelf_rows": 20, "pack": 4}),
    (7, 1.0, {"codewords": 5, "shelf_rows": 9, "pack": 7, "sample": 30}),
    (2, 1.0, {"shelf_rows": 33, "pack": 3}),
    (1, 1.0, {"codewords": 1, "shelf_rows": 50}),
])
def test_equals_all_pairs(spark, width, spread, options):
    rows = drawn(300, width, seed=width, spread=spread)
    want = expected(rows)
    assert want and found(spark, rows, **options) == want


def test_a_hot_vector_lies_on_several_shelves(spark):
    rows = drawn(120, 6, seed=9) + [(1000 + i, i % 2, [1.0] * 6) for i in range(150)]
    assert found(spark, rows, shelf_rows=16, pack=5) == expected(rows)


def test_large_numbers_are_exact(spark):
    draw = random.Random(2)
    for size in (50.0, 40000.0):
        rows = [(i, i % 3, [draw.uniform(-size, size) for _ in range(5)]) for i in range(60)]
        assert found(spark, rows) == expected(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(None, 1, [1.0, 2.0]), (5, None, [1.0, 2.0]), (10, 1, None), (15, 1, [nan, 1.0]),
           (20, 1, [inf, 1.0]), (25, 1, [None, 1.0]), (30, 1, [1e30, 1.0]), (35, 1, []),
           (40, 1, [1.0]), (45, 2, [1.0, 2.0, 3.0, 4.0]), (50, 1, [1.0, 2.0]), (50, 1, [1.0, 2.0]),
           (50, 2, [0.5, 2.0]), (55, 1, [-1.0, -2.0]), (-5, -3, [1.0, 1.0])]
    rows = odd + drawn(60, 2, seed=4)[3:]
    assert found(spark, rows, shelf_rows=10) == expected(rows)


def test_fewer_than_asked_for_extra_columns_and_empty_tables(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.1]), (2, 2, [0.5, 0.0])]
    extra = SCHEMA + ", cell string, shelf string, score string, vector string"
    wide = [(*r, "a", "b", "c", "d") for r in rows]
    assert found(spark, wide, schema=extra) == expected(rows) == {
        (0, 1, 1, 2, 65536, 32768)}
    assert found(spark, []) == set()
    assert found(spark, rows[1:]) == set()
    assert found(spark, rows[:1]) == set()


def test_the_heap_gives_all_pairs_by_falling_sums():
    draw = random.Random(1)
    for size in itertools.product(range(1, 7), range(1, 7)):
        left, right = (sorted((draw.choice([1.0, 2.0, draw.random()]) for _ in range(n)),
                              reverse=True) for n in size)
        got = list(hn.multi_sequence(left, right))
        assert len({(i, j) for _, i, j in got}) == len(got) == len(left) * len(right)
        assert [s for s, _, _ in got] == sorted((a + b for a in left for b in right), reverse=True)


def test_a_search_stops_where_bounds_allow(spark):
    """Among tight clusters an anchor's positives need few of the cells."""
    import pyarrow as pa
    rows = drawn(400, 8, seed=3, spread=0.02, centres=20)
    whole = hn.whole_numbers(spark.createDataFrame(rows, SCHEMA), 256)
    index, shelves = hn._fit(whole, 400, 8, 1000)
    table = shelves.toArrow()
    shelf, visited = hn.Shelf(index, table), []
    chunks = shelf.chunks
    shelf.chunks = lambda bounds: (visited.append(r) or (b, r) for b, r in chunks(bounds))
    hn._CHUNK, kept = 1, hn._CHUNK
    try:
        one = table.slice(0, 1).to_pylist()[0]
        vector = hn._matrix([one["vector"]], index.width)
        anchor = one | {"goals": [{"goal": 0, "low": -1 << 62, "high": 1 << 62,
                                   "floor": -1 << 62}]}
        best = list(shelf.search(anchor, vector[0].astype(index.exact),
                                 [b[0] for b in index.bounds(vector)], 5, True))
    finally:
        hn._CHUNK = kept
    assert len(best) == 5 and len(visited) < len(index.cells)
    assert isinstance(table, pa.Table)
