"""The two language models against plain versions, and by what they are for."""

import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

import reference as plain
from tidemark.llm import kneser_ney as kn
from tidemark.llm import pitman_yor as py


def grams_of(text):
    symbols = [255] * (kn.ORDER - 1) + list(text) + [255]
    return [tuple(symbols[i:i + kn.ORDER]) for i in range(len(text) + 1)]


def plain_kneser_ney(texts):
    """The probability of an n-gram, by the textbook recursion over dictionaries."""
    counts = collections.Counter()
    for text in texts:
        counts.update(grams_of(text))
    levels = {kn.ORDER: counts}
    for order in range(kn.ORDER - 1, 0, -1):
        levels[order] = collections.Counter(g[1:] for g in levels[order + 1])
    given = {}
    for order, grams in levels.items():
        n = collections.Counter(grams.values())
        d = kn.discounts(n[1], n[2], n[3], n[4])
        total, mass = collections.Counter(), collections.Counter()
        for g, c in grams.items():
            total[g[:-1]] += c
            mass[g[:-1]] += d[min(c, 3) - 1]
        given[order] = d, total, mass

    def probability(gram):
        if not gram:
            return 1 / kn.SYMBOLS
        d, total, mass = given[len(gram)]
        lower = probability(gram[1:])
        if gram[:-1] not in total:
            return lower
        c = levels[len(gram)][gram]
        share = (c - d[min(c, 3) - 1]) / total[gram[:-1]] if c else 0.0
        return share + mass[gram[:-1]] / total[gram[:-1]] * lower

    return probability


@pytest.mark.parametrize("block_bytes, together", [(1 << 20, 256), (20, 2)])
def test_kneser_ney_equals_the_recursion(spark, monkeypatch, block_bytes, together):
    """Also where the blocks are many, so that the shards are dealt out in copies."""
    monkeypatch.setattr(kn, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(kn, "BLOCKS_TOGETHER", together)
    texts = ["the cat sat. The cat ran!", "a cat, a dog; a bird", "", None, "the dog sat",
             "ÉÈ 123 xyz"]
    counts = kn.gram_counts(spark.createDataFrame([(t,) for t in texts], "text string"))
    probability = plain_kneser_ney([(t or "").encode() for t in texts])
    asked = ["the cat", "", None, "zebra 9", "É", "THE!!", "время", "the cat sat on a dog. " * 9,
             "the cat"] + texts
    rows = spark.createDataFrame(list(enumerate(asked)), "id bigint, text string").repartition(3)
    found = {r["id"]: r for r in kn.text_scores(rows, counts).collect()}
    assert len(found) == len(asked)
    for i, text in enumerate(asked):
        grams = grams_of((text or "").encode())
        assert found[i]["n_tokens"] == len(grams)
        assert found[i]["score"] == pytest.approx(
            sum(math.log10(probability(g)) for g in grams), rel=1e-5)


def test_kneser_ney_probabilities_sum_to_one(spark):
    """Over all symbols that may follow, after known and unknown contexts."""
    counts = kn.gram_counts(spark.createDataFrame([("abcab abd",), ("bcd",)], "text string"))
    tables = kn.model_tables(counts)
    answer = kn._answers(kn.collect_pairs(tables))
    rows = kn.sharded_model(tables).toArrow()
    for context in [b"abc", b" ab", b"xab", b"xya", b"xyz", b"\xff\xff\xff"]:
        codes = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)],
                         dtype=np.uint32)
        shards = kn._shard_of(codes >> np.uint32(8) & np.uint32(0xFFFF))
        assert len(set(shards)) == 1
        asked = pa.table({"block": [1], "shard": [int(shards[0])], "codes": [kn.packed_codes(codes)]})
        model = rows.filter(pa.compute.equal(rows["shard"], int(shards[0])))
        logs = np.frombuffer(answer(asked, model)["logs"][0].as_py(), dtype=np.float32)
        assert (10.0 ** logs.astype(float)).sum() == pytest.approx(1.0, rel=1e-5)


def test_kneser_ney_counts_long_texts_in_pieces(monkeypatch):
    texts = [bytes(range(32, 127)) * 30, b"", None, b"ab", bytes(range(97, 123)) * 7, b""]
    wanted = collections.Counter(g for t in texts for g in grams_of(t or b""))
    for piece in (1, 7, 100, len(texts[0]), 1 << 20):
        monkeypatch.setattr(kn, "_PIECE", piece)
        symbols, starts = kn.joined_texts(texts)
        found = collections.Counter(
            tuple(int(c).to_bytes(4, "big")) for _, codes, inside in kn.gram_pieces(symbols, starts)
            for c in codes[inside])
        assert found == wanted
        assert len(kn.distinct_grams(symbols, starts)) == len(wanted)


def test_quality_separates_labelled_documents(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    verdicts = kn.judged(docs, labels, sample=1500).join(labels, "doc_id")
    share = {r["quality"]: r["kept"] for r in verdicts.groupBy("quality").agg(
        {"kept": "count"}).withColumnRenamed("count(kept)", "kept").collect()}
    kept = {r["quality"]: r["n"] for r in verdicts.filter("kept").groupBy("quality").count()
            .withColumnRenamed("count", "n").collect()}
    assert kept[1] / share[1] > 0.995
    assert kept.get(0, 0) / share[0] < 0.15


def test_quality_of_a_rare_language(spark):
    """Few trusted documents among many: clean ones stay, whatever the sample takes of others."""
    rng = np.random.default_rng(6)
    words = {"aa": ["".join(rng.choice(list("etaoinshr"), 5)) for _ in range(300)],
             "bb": ["".join(rng.choice(list("qxzjkvwyg"), 5)) for _ in range(300)]}

    def text(lang, n):
        own, digits = words[lang], rng.random(n) < rng.uniform(0, 0.15)
        return " ".join("#7;Q" if d else own[i] for i, d in zip(rng.integers(0, 300, n), digits))

    rows = [(i, text("aa", 60), "aa") for i in range(3000)]
    rows += [(10_000 + i, text("bb", 60), "bb") for i in range(60)]
    rows += [(20_000 + i, "".join(rng.choice(list("!#7Qz;,Kx%"), 400)), lang)
             for i, lang in enumerate(["aa", "bb"] * 10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    for trusted in (3, 12):
        good = [*range(3000), *range(10_000, 10_000 + trusted)]
        labels = spark.createDataFrame([(i, 1) for i in good], "doc_id bigint, quality int")
        kept = {r["doc_id"] for r in kn.judged(docs, labels, sample=500).filter("kept").collect()}
        assert len([i for i in kept if i < 3000]) >= 0.985 * 3000
        assert len([i for i in kept if 10_000 <= i < 20_000]) >= 57
        assert not [i for i in kept if i >= 20_000]


SCRIPTS = {
    "ru": ("время человек год жизнь день работа слово место вопрос город дело сторона", 0x430, 32),
    "el": ("χρόνος άνθρωπος ημέρα ζωή εργασία λέξη τόπος ερώτηση πόλη κόσμος χώρα αρχή", 0x3B1, 25),
    "zh": ("时间 人们 生活 工作 学校 城市 国家 问题 世界 开始 地方 事情", 0x4E00, 9000),
    "en": ("time people year life day work word place question town matter side", 0x61, 26),
}


def test_texts_of_random_letters_are_rejected_in_any_script(spark):
    """A third of the clean texts of each language is trusted; nothing else is known."""
    rng, rows, labels = random.Random(6), [], []
    for lang, (words, first, letters) in SCRIPTS.items():
        words = words.split()
        for clean in (True, False):
            for k in range(150 if clean else 60):
                text = " ".join(rng.choice(words) if clean else "".join(
                    chr(first + rng.randrange(letters)) for _ in rng.choice(words))
                    for _ in range(rng.randrange(40, 80)))
                rows.append((len(rows), text, lang, clean))
                if clean and k % 3 == 0:
                    labels.append((rows[-1][0], 1))
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    judged = {r["doc_id"]: r["kept"] for r in kn.judged(
        docs, spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()}
    for lang in SCRIPTS:
        for clean in (True, False):
            kept = [judged[i] for i, _, of, good in rows if of == lang and good is clean]
            share = sum(kept) / len(kept)
            assert share >= 0.9 if clean else share <= 0.1, (lang, clean, share)


def test_thresholds(spark):
    rng = np.random.default_rng(7)
    logs = {"many": rng.normal(1.0, 0.1, 5000), None: rng.normal(2.0, 0.1, 1000), "one": [3.0]}
    texts = spark.createDataFrame([(lang, float(v)) for lang, all_ in logs.items() for v in all_],
                                  "lang string, log double")
    found, overall = kn.thresholds(texts, 0.99)
    limit = {r["lang"]: r["limit"] for r in found.collect()}
    assert overall == pytest.approx(np.quantile(np.concatenate(list(logs.values())), 0.99), abs=0.01)
    for lang in ("many", None):
        assert limit[lang] == pytest.approx(np.quantile(logs[lang], 0.99), abs=0.01)
    # One text has the spread of the others.
    assert limit["one"] == pytest.approx(3.0 + 0.23, abs=0.03)


def test_sample_is_taken_by_language(spark):
    docs = [(i, "big") for i in range(20_000)] + [(30_000 + i, "small") for i in range(50)]
    docs += [(40_000, "tiny")]
    table = spark.createDataFrame(docs, "doc_id bigint, lang string")
    last = {r["lang"]: r["last"] for r in kn.training_places(table, 1000).collect()}
    places = table.select("lang", kn._place().alias("place"), kn._held_out().alias("out")).collect()
    taken = collections.Counter(r["lang"] for r in places
                                if not r["out"] and r["place"] <= last[r["lang"]])
    assert 950 <= taken["big"] <= 1000
    assert taken["small"] == sum(not r["out"] for r in places if r["lang"] == "small")
    assert taken["tiny"] == 0 or any(r["out"] for r in places if r["lang"] == "tiny")


def test_quality_of_hard_rows(spark, hard, none):
    good = [(i, 1) for i in range(20)] + [(3, 0), (None, 1)]
    labels = spark.createDataFrame(good, "doc_id bigint, quality int")
    assert kn.judged(hard, labels).count() == hard.count()
    assert kn.kept_documents(hard, labels).columns == hard.columns
    nobody = kn.judged(hard, labels.filter("quality = 7"))
    assert nobody.filter("kept").count() == hard.count()
    assert kn.judged(none, labels).count() == 0


def plain_unigrams(docs):
    tokens = {i: [*plain.WORD.findall(plain.lower(t)), None] for i, t in docs.items()}
    counts = collections.Counter()
    for i, words in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    return {i: (zlib.crc32(str(i).encode()) % 7 == 2, len(words),
                sum(counts[w] > 0 for w in words), n,
                sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
            for i, words in tokens.items()}


def test_pitman_yor_base_and_gain(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    wanted = plain_unigrams({r["doc_id"]: r["text"] for r in docs.collect()})
    rows = py.document_scores(docs).collect()
    assert len(rows) == len(wanted)
    for r in rows:
        held, n, known, total, base = wanted[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == \
            (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.96 * sum(r["base_score"] for r in held)


def test_pitman_yor_reruns_agree_and_blocks_do_not_matter(spark, smallest, monkeypatch):
    docs = spark.read.parquet(f"{smallest}/documents.parquet")
    first = {r["doc_id"]: r for r in py.document_scores(docs).collect()}
    again = {r["doc_id"]: r for r in py.document_scores(docs).collect()}
    assert first == again
    # More blocks, whose requests are united over several levels.
    monkeypatch.setattr(py, "FAN_IN", 2)
    levels = py.united_requests(
        py.blocks_of(docs.repartition(7), 8).filter("shard >= 0").select(
            "shard", "block", "keys", "counts"), 7)
    assert len(levels) == 2
    cut = {r["doc_id"]: r for r in py.document_scores(docs.repartition(7)).collect()}
    assert first == cut


def test_pitman_yor_hard_rows(spark, hard, none):
    rows = py.document_scores(hard).collect()
    assert len(rows) == hard.count()
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert py.document_scores(none).count() == 0
    only_held = spark.createDataFrame([(i, "some words") for i in range(40)
                                       if zlib.crc32(str(i).encode()) % 7 == 2],
                                      "doc_id bigint, text string")
    for r in py.document_scores(only_held).collect():
        assert (r["n_known"], r["train_tokens"], r["n_tokens"]) == (0, 0, 3)
        assert r["base_score"] == pytest.approx(0.0) and r["score"] == pytest.approx(0.0)


def shard_of(rows):
    """A shard with all dishes, from (word, context) -> count."""
    keys = np.array([(w << py.CONTEXT_BITS) | c for w, c in rows], dtype=np.uint64)
    order = np.argsort(keys)
    return py.Shard(keys[order], np.array(list(rows.values()))[order])


def test_pitman_yor_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    contexts = [0, 64, 65, 130, 4095]
    rows = {(w, c): int(rng.integers(0, 6) ** 3) for w in range(1, 40) for c in contexts}
    shard = shard_of(rows)
    vocabulary = int(np.count_nonzero(shard.word_counts))
    seating = shard.seating()
    model = py.Model((0.6, 0.5, 0.4), vocabulary, py.Totals.of(seating.totals()))
    for _ in range(3):
        seating = seating.sweep(model, rng)
    exact = py.Totals.of(seating.totals())
    pair, _, root = seating.probabilities(model, exact)
    known = np.repeat(shard.word_counts > 0, np.diff(np.r_[shard.word_first, len(pair)]))
    unknown = shard_of({(99, c): 0 for c in contexts}).seating()
    rest = unknown.probabilities(model, exact)[0]
    for i, c in enumerate(contexts):
        total = pair[(shard.context == c) & known].sum() + rest[i]
        assert total == pytest.approx(1.0)
    assert np.all(seating.tables <= shard.counts)
    assert np.all((seating.tables > 0) == (shard.counts > 0))


def test_number_of_tables_has_the_exact_distribution():
    """Against the sum over all partitions of a few customers."""
    discount, weight, customers = 0.4, 0.7, 5

    def partitions(sizes, left):
        if not left:
            yield 1.0, len(sizes)
            return
        for i, size in enumerate(sizes):
            for p, t in partitions([*sizes[:i], size + 1, *sizes[i + 1:]], left - 1):
                yield p * (size - discount), t
        for p, t in partitions([*sizes, 1], left - 1):
            yield p * weight, t

    mass = collections.Counter()
    for p, t in partitions([], customers):
        mass[t] += p
    total = sum(mass.values())
    drawn = py.draw_tables(np.full(60000, customers), np.full(60000, weight), discount,
                           np.random.default_rng(3))
    for t in range(1, customers + 1):
        assert (drawn == t).mean() == pytest.approx(mass[t] / total, abs=0.01)


def test_many_customers_sit_as_if_one_by_one():
    discount, weight, customers = 0.3, 2.0, 1000
    rng = np.random.default_rng(4)
    drawn = py.draw_tables(np.full(3000, customers), np.full(3000, weight), discount, rng)
    start = py.draw_tables(np.full(3000, py.WHOLE), np.full(3000, weight), discount, rng)
    tables = start.astype(float)
    for n in range(py.WHOLE, customers):
        tables += rng.random(3000) < weight / (weight + n - discount * tables)
    assert drawn.mean() == pytest.approx(tables.mean(), rel=0.03)


def test_packing():
    keys = np.sort(np.random.default_rng(0).integers(0, 2**64, 1000, dtype=np.uint64))
    assert np.array_equal(py.unpacked(py.packed(keys), "u8"), keys)
    for kind in ("i4", "i8", "f4"):
        values = np.arange(-50, 50).astype(kind)
        assert np.array_equal(py.unpacked(py.packed(values), kind), values)
