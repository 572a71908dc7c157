"""The pipeline's stages against plain versions, on documents with planted cases."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
import reference as plain
from conftest import EXTRA
from tidemark.llm import mixing, secrets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df, columns=COLUMNS):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def folder(spark, small, tmp_path_factory):
    """The small documents with planted passages, copies and secrets, and hard rows."""
    out = tmp_path_factory.mktemp("planted")
    docs = spark.read.parquet(f"{small}/documents.parquet").filter("doc_id < 400")
    rng = random.Random(1)
    items = [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    plain_text = [r["text"] for r in docs.filter("lang = 'en' AND length(text) BETWEEN 1500 AND 9000")
                  .orderBy("doc_id").limit(12).collect()]
    extra = []
    for k, text in enumerate(plain_text):
        words = text.split(" ")
        cut = rng.randrange(len(words))
        extra.append((10_000 + k, " ".join(words[:cut] + [items[k]] + words[cut:]), "en", "new", 1))
        near = words[:cut] + ["slightly"] + words[cut:]
        extra.append((20_000 + k, " ".join(near), "en", "new", 1))
        extra.append((30_000 + k, text, "fr", None, 1))
    extra += [(40_000, None, None, None, None), (40_001, "", "xx", "new", 0), (40_001, "", "xx", "new", 0),
              (None, plain_text[0], "en", "src1", 5)]
    planted = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    planted.write.parquet(f"{out}/documents.parquet")
    for table in ("benchmark", "labels"):
        spark.read.parquet(f"{small}/{table}.parquet").write.parquet(f"{out}/{table}.parquet")
    return str(out)


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_near_duplicates(spark, docs, folder):
    found = rows(pipeline.near_duplicates(spark, docs, folder))
    table = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    classes = {}
    for n, (_, _, least) in enumerate(plain.components(
            [(n, plain.fingerprint(r[1])) for n, r in enumerate(table)])):
        classes.setdefault(least, set()).add(table[n])
    assert len(found) == len(classes)
    for row in found:
        mine = [c for c in classes.values() if row in c]
        assert len(mine) == 1
        ids = [r[0] for r in mine[0] if r[0] is not None]
        assert row[0] == min(ids, default=None)


def test_decontamination(spark, docs, folder):
    kept = {r[0] for r in rows(pipeline.decontamination(spark, docs, folder))}
    assert not kept & set(range(10_000, 10_012))
    items = [" ".join(r["text"].lower().replace(".", " ").replace(",", " ").split())
             for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for r in docs.collect():
        if r["doc_id"] is None or r["doc_id"] in kept:
            continue
        # Whatever goes shares at least a few words in a row with an item.
        words = (r["text"] or "").lower().replace(".", " ").replace(",", " ").split()
        runs = {" ".join(words[i:i + 4]) for i in range(len(words) - 3)}
        assert any(run in item for run in runs for item in items)
    whole = {r["doc_id"] for r in docs.collect()
             if any(i in " ".join((r["text"] or "").lower().replace(".", " ").replace(",", " ").split())
                    for i in items)}
    assert not whole & kept


def test_secrets(spark, docs, folder):
    found = rows(pipeline.secret_redaction(spark, docs, folder))
    wanted = []
    for r in docs.select(*COLUMNS).collect():
        text = r["text"] if r["text"] is None else secrets.redact(
            r["text"], secrets.VOCABULARY, secrets.CHARACTERS_PER_TOKEN, "<SECRET>")
        wanted.append((r["doc_id"], text, r["lang"], r["source"],
                       None if text is None else len(text)))
    assert found == sorted(wanted, key=repr)


def test_mixing(spark, docs, folder):
    copies = {}
    for r in pipeline.source_mix(spark, docs, folder).collect():
        copies.setdefault(r["doc_id"], []).append(r["copy"])
    rated = {r["doc_id"]: r["copies"] for r in mixing.mixture(docs).collect()
             if r["doc_id"] not in (40_001, None)}
    assert {k: len(copies.get(k, [])) for k in rated} == rated
    assert all(sorted(c) == sorted(set(c)) or k in (40_001,) for k, c in copies.items())
    assert max(max(c) for c in copies.values()) <= 2


def test_quality_keeps_good_and_drops_junk(spark, docs, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept = pipeline.quality(spark, docs, folder)
    assert kept.columns == docs.columns
    judged = docs.join(labels, "doc_id").groupBy("quality").count().collect()
    after = {r["quality"]: r["count"] for r in kept.join(labels, "doc_id").groupBy("quality")
             .count().collect()}
    before = {r["quality"]: r["count"] for r in judged}
    assert after[1] > 0.97 * before[1] and after.get(0, 0) < 0.5 * before[0]


def test_run_equals_the_stages_in_turn(spark, docs, folder):
    step = docs
    for _, stage in pipeline.STAGES:
        step = stage(spark, step, folder)
    assert rows(pipeline.run(spark, folder), [*COLUMNS, "copy"]) == rows(step, [*COLUMNS, "copy"])


def test_stages_on_hard_rows_and_empty_tables(spark, hard, none, folder, tmp_path):
    """Every extra column keeps its name and values, whatever the stage calls its own."""
    for name, stage in pipeline.STAGES:
        stage(spark, hard, folder).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        assert out.columns[:len(hard.columns)] == hard.columns, name
        own = out.columns[len(hard.columns):]
        assert own == (["copy_3"] if name == "mixing" else []), name
        found = out.collect()
        assert found and all(r[c] == f"extra {c}" for r in found for c in EXTRA), name
        assert stage(spark, none, folder).count() == 0, name


def test_rows_that_differ_by_the_place_of_a_null_both_stay(spark, folder):
    """Their copies do not, and neither is taken for the other."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    texts = ["one two three four five", "six seven eight nine ten"]
    rows_of = [(1, texts[0], "en", None, 1), (1, texts[1], None, "en", 1)]
    docs = spark.createDataFrame(rows_of * 3, schema)
    assert rows(pipeline.near_duplicates(spark, docs, folder)) == sorted(rows_of, key=repr)
