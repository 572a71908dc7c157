"""The manifest against hashing all leaves in one list, at several sizes of superblocks."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import hard_rows
from tidemark.llm import manifest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    return digest("".join(
        "-" if v is None else f"{len(str(v).encode())}:{v}"
        for v in (doc_id, source, lang, n_chars, text)))


def tree_of(digests):
    """The root, and for every leaf its siblings with whether they are on the left."""
    ways, places = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for way, place in zip(ways, places):
            other = place ^ 1
            way.append((other < place, digests[other] if other < len(digests) else None))
        digests = [digest("".join(digests[i:i + 2])) for i in range(0, len(digests), 2)]
        places = [p // 2 for p in places]
    return digests[0], ways


def expected(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append((row, leaf_of(*row)))
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[lang] = tree_of([leaf for _, leaf in by_lang[lang]])
    root, top = tree_of([trees[lang][0] for lang in langs]) if langs else (None, [])
    result = []
    for lang, out in zip(langs, top):
        subroot, ways = trees[lang]
        for (row, leaf), way in zip(by_lang[lang], ways):
            doc_id, text, _, source, n_chars = row
            claim = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
                claim = leaf_of(doc_id, text, lang, source,
                                None if n_chars is None else n_chars + 1)
            way = way + out
            for left, sibling in way:
                claim = digest((sibling or "") + claim if left else claim + (sibling or ""))
            result.append((doc_id, leaf, subroot, root,
                           digest("".join(s for _, s in way if s)), claim, claim == root))
    return sorted(map(str, result))


def found(docs, **options):
    rows = manifest.manifest(docs, manifest.tampered_by_crc(), **options)
    assert rows.columns == NAMES
    return sorted(str(tuple(r)) for r in rows.collect())


def drawn(count, langs, seed=1):
    draw = random.Random(seed)
    return [(i * 3 - 50, f"text {draw.random()}é", draw.choice(langs), draw.choice([None, "a"]),
             draw.choice([None, 5, 2**63 - 1])) for i in range(count)]


@pytest.mark.parametrize("levels, count, langs", [
    (12, 300, ["en", "de", None, ""]),
    # Several floors, trees of every kind of size beside each other.
    (2, 300, ["en"] * 20 + ["de"] * 3 + [None]),
    (1, 65, ["en"] * 9 + ["é", "z"]),
    (3, 64, ["en"]),
    # More languages than a superblock has leaves: the tree over them has floors too.
    (2, 120, [f"l{i}" for i in range(40)] + [None] * 40),
])
def test_equals_one_list(spark, levels, count, langs):
    rows = drawn(count, langs)
    got = found(spark.createDataFrame(rows, SCHEMA).repartition(5), levels=levels)
    assert got == expected(rows)
    assert any("True" in r for r in got) and any("False" in r for r in got)


def test_one_leaf_is_its_own_root(spark):
    row = (1, "only", "en", None, 4)
    (got,) = manifest.manifest(spark.createDataFrame([row], SCHEMA), F.lit(False)).collect()
    assert got.leaf == got.subroot == got.root == leaf_of(*row) and got.verified
    assert got.proof_sha256 == digest("")


@pytest.mark.parametrize("levels", [2, 12])
def test_hard_rows_repeated_rows_and_extra_columns(hard, levels):
    extra = hard.selectExpr("*", "1 AS leaf", "2 AS tree", "3 AS at", "4 AS `block`", "5 AS row")
    assert found(extra, levels=levels) == expected(hard_rows())


def test_repeated_rows_hold_most_of_the_table(spark):
    rows = drawn(40, ["en", "de"]) + [(7, "copy", "en", "a", 4)] * 200
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(6), levels=3) == expected(rows)


def test_places_follow_the_order_over_many_ranges(spark):
    rows = drawn(2000, ["en", "en", "de"])
    docs = spark.createDataFrame(rows, SCHEMA).repartition(9)
    written = manifest.materialise(
        manifest.leaves(docs, F.lit(False)).withColumn("row", F.monotonically_increasing_id()),
        "leaves")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = manifest._placed(written, ["doc_id", "leaf", "row"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for tree in ("=en", "=de"):
        ids = [(r["at"], r.doc_id) for r in placed if r.tree == tree]
        assert [d for _, d in sorted(ids)] == sorted(d for _, d in ids)
        assert sorted(a for a, _ in ids) == list(range(len(ids)))
        assert {r["size"] for r in placed if r.tree == tree} == {len(ids)}


def test_an_empty_table(none):
    assert found(none) == []
