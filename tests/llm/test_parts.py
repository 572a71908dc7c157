"""Parts of the operators, and cases made for one method."""

import itertools
import random
import string

import numpy as np
import pytest

import reference as plain
from tidemark.llm import (common, decontaminate, licenses, mixing, pii, quality_rules, secrets,
                          simhash)
from tidemark.llm.components import connected


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    text = (" ".join(f"w{i * 7919 % 1000}" for i in range(3000)) + " " + "z" * 900).encode()
    whole = common.word_hashes(text, common.BLANKS)
    words = text.split()
    assert len(set(whole.tolist())) == len(set(words))
    assert [whole[0] == h for h in whole] == [words[0] == w for w in words]
    monkeypatch.setattr(common, "_PIECE", 1000)
    assert np.array_equal(common.word_hashes(text, common.BLANKS), whole)
    monkeypatch.setattr(common, "_PIECE", 100)
    pieces = common.word_hashes(text, common.BLANKS)
    assert np.array_equal(pieces[:-1], whole[:-1]) and len(pieces) == len(whole)


def test_running_sums(spark):
    arrays = [[], [5], list(range(200)), None, [1] * 64, [2] * 65]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "i int, a array<bigint>")
    found = dict(df.select("i", common.running_sums("a")).collect())
    for i, a in enumerate(arrays):
        wanted = None if a is None else [sum(a[:k]) for k in range(len(a))]
        assert (found[i] or []) == (wanted or [])


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1000, i) for i in range(1, 50)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (5, 3), (3, 5)], "a bigint, b bigint")
    found = dict(connected(links).collect())
    assert {found[i] for i in range(100, 161)} == {100}
    assert {found[i] for i in [*range(1, 50), 1000]} == {1}
    assert set(found) == {*range(100, 161), *range(1, 50), 1000}
    assert connected(links.filter("a < 0")).count() == 0


@pytest.mark.parametrize("group_rows", [4096, 40])
def test_links_join_the_same_classes_at_any_group_size(spark, group_rows):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = {c for c in centres}
    for c in centres:
        for _ in range(60):
            prints.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    prints |= {0, 7, rng.getrandbits(64)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.linked(spark.createDataFrame(signed, "fp bigint"), group_rows=group_rows)
    found = dict(connected(links).collect())
    groups = {}
    for p, (s,) in zip(prints, signed):
        groups.setdefault(found.get(s, s), set()).add(p)
    wanted = {}
    for row, (p, _, least) in zip(prints, plain.components([(p, p) for p in prints])):
        wanted.setdefault(least, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_longer_masks_let_no_close_pair_apart():
    rng = random.Random(2)
    for mask in (0, simhash.longer_masks(0, 3)[4]):
        masks = simhash.longer_masks(mask, 3)
        free = [i for i in range(64) if not mask >> i & 1]
        for _ in range(200):
            difference = sum(1 << b for b in rng.sample(free, 3))
            assert any(not difference & m for m in masks)


def sentence(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_passages_with_replaced_tokens_are_found(spark):
    rng = random.Random(9)
    items = [(i, " ".join(sentence(rng, n))) for i, n in enumerate([40, 30, 25, 14, 6, 60])]
    items += [(6, None), (7, " .,; "), (8, items[0][1])]
    docs, wanted = [], set()
    for i, text in items[:6]:
        words = text.split()
        docs.append((len(docs), " ".join(sentence(rng, 50) + words + sentence(rng, 9))))
        wanted.add((len(docs) - 1, i))
        if len(words) >= 25:
            changed = list(words)
            for at in range(5, len(words), 9):
                changed[at] = "other"
            docs.append((len(docs), " ".join([*sentence(rng, 20), *changed]).upper()))
            wanted.add((len(docs) - 1, i))
            docs.append((len(docs), ", ".join(words[:15]) + " - " + " ".join(sentence(rng, 30))))
            wanted.add((len(docs) - 1, i))
            # Eight equal tokens and every second token are no passage.
            docs.append((len(docs), " ".join(words[:8] + sentence(rng, 40))))
            docs.append((len(docs), " ".join(w if k % 2 else "x" for k, w in enumerate(words))))
    wanted |= {(d, 8) for d, i in wanted if i == 0}
    docs += [(100, None), (101, ""), (102, "...")]
    docs.append(docs[0])
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = decontaminate.overlaps(table, spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == wanted
    assert found.count() == len(wanted)


def test_decontamination_without_rows(spark, none, hard):
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.overlaps(hard, items).count() == 0
    some = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog the quick brown "
                                      "fox jumps")], "item_id bigint, text string")
    assert decontaminate.overlaps(none, some).count() == 0
    assert {r["doc_id"] for r in decontaminate.overlaps(hard, some).collect()} == {15}


def test_items_with_one_id_or_none_are_compared_each(spark):
    first, second, third = (" ".join(f"{name}{i}" for i in range(20)) for name in "abc")
    docs = spark.createDataFrame(
        [(1, f"{third} x {first} y {second}"), (2, second), (3, "clean words only")],
        "doc_id bigint, text string")
    items = spark.createDataFrame([(7, first), (7, second), (None, third)],
                                  "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]): (r["first_token"], r["n_tokens"])
             for r in decontaminate.overlaps(docs, items).collect()}
    assert found == {(1, 7): (21, 20), (1, None): (0, 20), (2, 7): (0, 20)}


def test_best_run():
    region = np.array([9, 9, 1, 2, 3, 4, 8, 6, 7, 9])
    item = np.array([1, 2, 3, 4, 5, 6, 7])
    assert decontaminate.best_run(region, item, 2) == (2, 4, 4)
    long = np.arange(100)
    other = long.copy()
    other[50] = -1
    assert decontaminate.best_run(long, other, 0) == (0, 100, 99)
    assert decontaminate.best_run(region, item, 50) == (0, 0, 0)


def test_masks_meet_every_passage():
    """Every pattern of replaced tokens; longer passages hold one of at most 23 tokens."""
    for n in range(1, 24):
        masks = decontaminate.masks_for(n)
        places = [sum(1 << at + i for i, looked_at in enumerate(mask) if looked_at == "1")
                  for mask in masks for at in range(n - len(mask) + 1)]
        for replaced in itertools.combinations(range(n), n // 5):
            bits = sum(1 << i for i in replaced)
            assert any(not bits & place for place in places), (n, replaced)


def test_short_passages_with_replaced_tokens_are_found(spark):
    rng = random.Random(3)
    items, docs = [], []
    for n in [*range(5, 24), 30, 50]:
        for _ in range(8):
            words = sentence(rng, n)
            items.append((len(items), " ".join(words)))
            for at in rng.sample(range(n), n // 5):
                words[at] = "other"
            docs.append((len(docs), " ".join(sentence(rng, 30) + words + sentence(rng, 30))))
    # The cases of the finding: every fifth token replaced.
    for n in (20, 50):
        words = sentence(rng, n)
        items.append((len(items), " ".join(words)))
        docs.append((len(docs), " ".join("x" if k % 5 == 0 else w for k, w in enumerate(words))))
    # Seven of nine tokens are no passage.
    words = sentence(rng, 9)
    items.append((len(items), " ".join(words)))
    docs.append((len(docs), " ".join(["x", *words[1:4], "x", *words[5:]])))
    wanted = {(i, i) for i in range(len(docs) - 1)}
    found = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                   spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == wanted


def test_longest_run():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        item = np.arange(n)
        region = np.where(rng.random(n) < 0.25, -1, item)
        agree = region == item
        runs = [(j - i, int(agree[i:j].sum())) for i in range(n) for j in range(i + 1, n + 1)]
        longest = max((m for m, a in runs if 5 * a >= 4 * m), default=0)
        start, length, equal = decontaminate.longest_run(region, item, 0)
        assert length == longest and equal == agree[start:start + length].sum()
        assert 5 * equal >= 4 * length


@pytest.mark.parametrize("text, labels, reusable", [
    ("mit", {"mit"}, True), ("gpl-3.0-or-later", {"gpl"}, False),
    ("mit or gpl-2.0", {"mit", "gpl"}, True), ("mit and gpl-2.0", {"mit", "gpl"}, False),
    ("gpl-2.0 with classpath-exception-2.0 or mit", {"gpl", "mit"}, True),
    ("mit or gpl-2.0 and cc-by-nc-4.0", {"mit", "gpl", "cc-by-nc"}, True),
    ("(mit or gpl-2.0) and cc-by-nc-4.0", {"mit", "gpl", "cc-by-nc"}, False),
    ("mit and unknown-1.0", {"mit"}, None), ("mit or unknown-1.0", {"mit"}, True),
    ("(mit", set(), None), ("and mit", set(), None), ("mit or", set(), None),
    ("mit this text goes on", {"mit"}, True), ("", set(), None)])
def test_licence_expressions(text, labels, reusable):
    assert licenses.evaluate(text) == (labels, reusable)


def test_licence_tag_in_text():
    two = licenses.scan(b"SPDX-License-Identifier: ISC SPDX-License-Identifier: Zlib")
    assert two[5] == "isc,zlib"
    long = licenses.scan(b"SPDX-License-Identifier: " + b"MIT OR " * 200 + b"GPL-2.0")
    assert long[5] == "gpl,mit" and long[8] is True
    found = licenses.scan(b"// SPDX-License-Identifier: Apache-2.0 OR MIT\ncode")
    assert found[5] == "apache,mit" and found[6] == 1.0 and found[8] is True


@pytest.mark.parametrize("names, labels, expression, reusable", [
    (["EPL-2.0"], "epl-2.0", "epl-2.0", None), (["0BSD"], "0bsd", "0bsd", None),
    (["LicenseRef-own.1 OR MIT"], "licenseref-own.1,mit", "licenseref-own.1 or mit", True),
    (["EPL-2.0 AND GPL-2.0"], "epl-2.0,gpl", "epl-2.0 and gpl-2.0", False),
    (["GPL-2.0 WITH Classpath-exception-2.0"], "gpl", "gpl-2.0 with classpath-exception-2.0", False),
    (["MIT", "EPL-2.0"], "epl-2.0,mit", "mit", None),
    (["EPL-2.0", "MIT"], "epl-2.0,mit", "epl-2.0", None),
    (["MIT AND unknown-1.0", "MIT"], "mit,unknown-1.0", "mit and unknown-1.0", None),
    (["MIT", "(MIT"], "mit", "mit", None), (["(MIT"], "", "(mit", None),
    (["", "MIT"], "mit", "mit", None), (["EPL-2.0", "GPL-2.0", "MIT"], "epl-2.0,gpl,mit", "epl-2.0", False),
    (["MIT", "ISC"], "isc,mit", "mit", True)])
def test_licence_tags_of_unknown_identifiers(names, labels, expression, reusable):
    found = licenses.scan("\n".join(f"SPDX-License-Identifier: {n}" for n in names).encode())
    assert (found[5], found[7], found[8]) == (labels, expression, reusable)
    assert found[6] == (1.0 if labels else 0.0)


def brute_overlap(doc, item):
    """Whether any stretch of any diagonal is a passage, by its definition; all pairs."""
    for shift in range(1 - len(item), len(doc)):
        start, end = max(shift, 0), min(shift + len(item), len(doc))
        agree = [doc[i] == item[i - shift] for i in range(start, end)]
        for a in range(len(agree)):
            for b in range(a + min(12, len(item)), len(agree) + 1):
                if sum(agree[a:b]) >= 0.8 * (b - a):
                    return True
    return False


def test_overlaps_equal_all_pairs_of_documents_items_and_diagonals(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(60)]
    items = [[rng.choice(words) for _ in range(n)] for n in (1, 2, 4, 5, 7, 11, 12, 13, 20, 30, 45)]
    items += [items[9][:16] + [rng.choice(words) for _ in range(14)] for _ in range(4)]
    docs = []
    for _ in range(150):
        doc = [rng.choice(words) for _ in range(rng.randrange(40))]
        for item in rng.sample(items, 2):
            a = rng.randrange(len(item))
            part = item[a:a + rng.randrange(3, 40)]
            part = [rng.choice(words) if rng.random() < rng.choice([0, 0.1, 0.25]) else w
                    for w in part]
            at = rng.randrange(len(doc) + 1)
            doc[at:at] = part
        docs.append(doc)
    table = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)],
                                  "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)],
                                      "item_id bigint, text string")
    want = {(i, j) for i, d in enumerate(docs) for j, t in enumerate(items) if brute_overlap(d, t)}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(table, benchmark).collect()}
    assert got == want and len(want) > 100
    for row in decontaminate.contaminated(table, benchmark).collect():
        mine = sorted(j for i, j in want if i == row["doc_id"])
        assert row["items"] == ",".join(map(str, mine)) and row["n_items"] == len(mine)
        assert row["item_id"] in mine
        assert row["condemned"] == any(len(items[j]) >= 5 for j in mine)
    assert {i for i, _ in want} == {r["doc_id"] for r in decontaminate.contaminated(
        table, benchmark).collect()}


def test_a_shared_instruction_gives_one_row_per_document(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    shared = " ".join(rng.sample(words, 16))
    items = [(i, f"{shared} {' '.join(rng.sample(words, 12))}") for i in range(40)] + [(99, "yes")]
    docs = [(i, f"{' '.join(rng.sample(words, 20))} {shared} yes") for i in range(30)] + [
        (1000 + i, "oh yes indeed") for i in range(30)]
    found = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r["doc_id"], r["n_items"], r["condemned"]) for r in found} == {
        (i, 41, True) for i in range(30)} | {(1000 + i, 1, False) for i in range(30)}


def keys_in(text):
    """The parts of a text that are taken for random keys."""
    spans = secrets.all_spans(text, secrets.base_spans(text), secrets.VOCABULARY, 2.0)
    return [text[a:b] for a, kind, b in spans if kind == 3]


def test_random_strings():
    assert keys_in("aZ3fQ9xL2mN8vB4kT7pR1wY6cD5gH0jS") == ["aZ3fQ9xL2mN8vB4kT7pR1wY6cD5gH0jS"]
    for known in ("d41d8cd98f00b204e9800998ecf8427e", "550e8400-e29b-41d4-a716-446655440000",
                  "internationalization", "2024-01-31-2024-02-28", "some/path/to/files",
                  "averylongwordofthetext123"):
        assert not keys_in(known)


@pytest.mark.parametrize("before, after", [
    ("", ""), ("static/assets/application/vendor/images/", ""), ("id=", "&"), ("SECRET_KEY=", "="),
    ("https://example.com/api/v1/resources/users/download/archive/", "/index"),
    ("token=abcdef ", ""), ("password: hunter22,", ""), ("the-key-is_", "-and-more"),
    ("550e8400-e29b-41d4-a716-446655440000/", ""), ("0123456789abcdef01234567_", "")])
def test_keys_are_found_wherever_they_stand(before, after):
    rng = random.Random(9)
    for n in (20, 24, 32, 40):
        found = 0
        for _ in range(200):
            key = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
            (start, end), text = (len(before), len(before) + n), before + key + after
            covered = sum(min(b, end) - max(a, start) for a, kind, b in secrets.all_spans(
                text, secrets.base_spans(text), secrets.VOCABULARY, 2.0)
                if a < end and b > start)
            found += covered >= 0.9 * n
        assert found >= 180, (n, found)


def test_a_base_span_that_holds_the_key_is_enough():
    text = "token=abcdef/aZ3fQ9xL2mN8vB4kT7pR1wY6cD5gH0jS"
    assert secrets.redact(text, secrets.VOCABULARY, 2.0, "#") == "#"


def test_known_forms_inside_a_run_and_slugs_are_left_alone():
    for text in ("/users/550e8400-e29b-41d4-a716-446655440000/profile",
                 "id=550E8400-E29B-41D4-A716-446655440000", "gcc-4-9-2-el7-x86_64-linux-gnu",
                 "SHA1=DA39A3EE5E6B4B0D3255BFEF95601890AFD80709", "a/b/c/d/e/f/g/h/i/j/k/l/m/n/o",
                 "md5/D41D8CD98F00B204E9800998ECF8427E/of-nothing", "2024-01-15-12-30-45-000001",
                 "the-quick-brown-fox-jumps-over-the-lazy-dog", "PYSPARK_SUBMIT_ARGS_FOR_TESTS",
                 "DELTA_BINARY_PACKED_DTYPES", "v1/2/3/4/5/6/7/8/9/10/11/12"):
        assert not keys_in(text), text


def test_two_keys_and_a_word_between():
    one, two = "aZ3fQ9xL2mN8vB4kT7pR1w", "Xk2Qv7Zt9Lw4Hj6Rb8Np3D"
    assert keys_in(f"{one}/documentation/{two}") == [one, two]
    assert keys_in("0123456789abcdef01234567" + "/" + one) == [one]


def test_very_long_runs_are_searched_whole():
    key = "aZ3fQ9xL2mN8vB4kT7pR1wY6cD5gH0jS"
    text = "word/" * 20000 + key + "/word" * 20000 + "1" * 30000
    assert keys_in(text) == [key]


def test_random_letters_are_secrets_and_words_are_not():
    rng = random.Random(8)
    alphabets = {string.ascii_letters: 0.99, string.ascii_letters + string.digits: 0.999,
                 string.ascii_letters + string.digits + "+/": 0.99,
                 string.ascii_uppercase: 0.95, string.ascii_lowercase: 0.85}
    for alphabet, share in alphabets.items():
        for n in (20, 24, 32, 40):
            found = sum(bool(keys_in("".join(rng.choice(alphabet) for _ in range(n))))
                        for _ in range(400))
            assert found >= share * 400 - 2, (alphabet, n, found)
    for known in ("getElementsByTagNameNS", "AbstractSingletonProxyFactoryBean",
                  "MAX_BUFFER_SIZE_IN_BYTES", "GET_DB_ID_BY_USER_ID", "EN/DE/FR/ES/IT/NL/PT",
                  "src/main/java/com/example/App", "Rechtsschutzversicherungsgesellschaften",
                  "anticonstitutionnellement", "user_profile_settings_v2", "z" * 30,
                  "sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=", "2024/01/31/2024/02/28"):
        assert not keys_in(known), known
    key = "qLzWvTbXkRjPmHdGnCfYsE"
    assert secrets.redact(f"a {key} b", secrets.VOCABULARY, 2.0, "#") == "a # b"


def test_redaction(spark, hard):
    out = secrets.redacted(hard)
    assert out.columns == hard.columns and out.count() == hard.count()
    for r in out.filter("text IS NOT NULL").collect():
        assert r["n_chars"] == len(r["text"])
        assert plain.secret_base(r["text"])[-1] == [] or "<SECRET>" in r["text"]
    key = "aZ3fQ9xL2mN8vB4kT7pR1wY6cD5gH0jS"
    assert secrets.redact(f"a {key} b", secrets.VOCABULARY, 2.0, "#") == "a # b"
    assert secrets.redact("token=deadbeefdeadbeefdeadbeef!", secrets.VOCABULARY, 2.0, "#") == "#!"


def hosts_rejected(spark, hosts):
    """The rejected hosts; `hosts` has per name how many documents it has and how many fail."""
    rows = [(i, "short" if k < failing else GOOD, name) for name, (docs, failing) in hosts.items()
            for i, k in enumerate(range(docs))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    limits = {"short": 0.5}
    return {r["host"] for r in quality_rules.judged(docs, limits=limits)
            .filter("host_failed").select("host").distinct().collect()}


#: Sixty different words.
GOOD = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))


def test_one_document_never_rejects_its_host(spark):
    # Nothing but hosts with one document, many of which fail.
    alone = {f"good{i}": (1, 0) for i in range(60)} | {f"bad{i}": (1, 1) for i in range(40)}
    assert hosts_rejected(spark, alone) == set()
    # Among hosts that differ a lot, and with a common rate just below the limit.
    mixed = alone | {f"all{i}": (20, 20) for i in range(3)} | {f"none{i}": (20, 0) for i in range(3)}
    assert hosts_rejected(spark, mixed) == {f"all{i}" for i in range(3)}


def test_hosts_alike_are_drawn_to_the_common_rate(spark):
    # All fail about a third: four of six is chance. Where hosts differ, four of six tells.
    alike = {f"h{i}": (30, 9 + i % 3) for i in range(20)} | {"four": (6, 4)}
    assert hosts_rejected(spark, alike) == set()
    apart = {f"h{i}": (30, 29 if i < 6 else 1) for i in range(20)} | {"four": (6, 4)}
    assert hosts_rejected(spark, apart) == {"four"} | {f"h{i}" for i in range(6)}


def test_the_prior_recovers_how_hosts_differ():
    rng = random.Random(4)
    for strength in (3.0, 30.0):
        hosts = []
        for _ in range(4000):
            rate = rng.betavariate(0.2 * strength, 0.8 * strength)
            n = rng.choice([1, 1, 1, 2, 5, 20])
            hosts.append((n, sum(rng.random() < rate for _ in range(n))))
        docs = sum(n for n, _ in hosts)
        mean = sum(f for _, f in hosts) / docs
        excess = sum(f * f / n for n, f in hosts) - docs * mean * mean
        found = quality_rules.prior_strength(mean, excess, len(hosts), docs, 0.9)
        assert strength / 1.5 < found < strength * 1.5
    # The same numbers without hosts of several documents say nothing.
    assert quality_rules.prior_strength(0.2, 0.16 * 100, 100, 100, 0.9) == 1e6


def test_hosts_that_fail_are_rejected(spark):
    good = " ".join(f"word{i}" for i in range(80))
    bad = " ".join(f"w{i} ###" for i in range(80))
    rows = [(i, good, f"h{i % 4}") for i in range(80)]
    rows += [(100 + i, bad if i < 18 else good, "bad") for i in range(20)]
    rows += [(200, bad, "tiny"), (300, good, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judged(docs).collect()}
    assert not any(kept[100 + i] for i in range(20))
    assert all(kept[i] for i in range(80)) and kept[300]
    # One failure on a host with a single document says little about the host.
    assert kept[200]


def test_em_finds_the_reliable_labelers():
    rng = random.Random(0)
    votes = {}
    for _ in range(4000):
        truth = rng.random() < 0.6
        v = tuple((1 if truth else -1) if rng.random() < p else (-1 if truth else 1)
                  for p in (0.95, 0.9, 0.85, 0.55, 0.5))
        votes[v] = votes.get(v, 0) + 1
    prior, tables, posterior = pii.reliabilities(sorted(votes.items()))
    assert prior == pytest.approx(0.6, abs=0.05)
    assert tables[0][1, 1] > 0.9 > tables[3][1, 1] and tables[4][1, 1] < 0.65
    weights = pii.train_classifier(sorted(votes.items()), posterior)
    assert weights[0, 1] > weights[3, 1] and weights[0, -1] < 0


def test_local_numbers_are_added(spark):
    text = "call me by phone 555-123-4567 today"
    docs = spark.createDataFrame(
        [(i, f"{text} tel +49 30 123456{i % 10}") for i in range(30)], "doc_id bigint, text string")
    row = pii.find_pii(docs).filter("doc_id = 1").first()
    assert row["n_phone"] == 1 and "phone:17:29" in row["spans"]


def test_mix_repeats_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = {r["doc_id"]: r for r in mixing.mixture(docs).collect()}
    out = mixing.mixed(docs)
    assert out.columns == [*docs.columns, "copy"]
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {i: r["copies"] for i, r in plan.items() if r["copies"]}
    for source in ("src0", "src1", "src2"):
        rows = [plan[r["doc_id"]] for r in docs.filter(docs.source == source).collect()]
        assert sum(r["taken"] for r in rows) == pytest.approx(rows[0]["target"], rel=0.35)
