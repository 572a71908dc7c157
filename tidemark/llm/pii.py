"""Personal data by weak supervision, with DataFrame functions only.

Candidates are what the fixed patterns match, what these reject (a number that fails its
checksum), and looser forms. Labelers vote on each candidate: its form, a gazetteer of known
endings and prefixes, the words before it, its borders, and signs of a made-up value. Votes are
yes (1), no (-1) or none (0). Expectation-maximisation estimates how reliable each labeler is
for each kind of data, without any labels, and gives each pattern of votes a probability. A
logistic model trained on these probabilities is the final classifier; it is a sum of constants
over the votes, so Spark applies it as an expression.

The number of different (kind, votes) patterns is fixed by the labelers, whatever the input:
only their counts reach the driver, over all documents.

Spans count code points, end exclusive. What the fixed patterns accept stays; other candidates
are added if the classifier accepts them and they touch no fixed span. Null and empty texts have
none. Texts are searched whole; repeated rows give a row each; other columns do not matter; an
empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Row, functions as F

from tidemark.llm.common import running_sums
from tidemark.session import materialise

KINDS = ("email", "ip", "card", "phone", "ssn", "iban")
BASE_KINDS = KINDS[:4]
LABELERS = ("form", "gazetteer", "context", "borders", "genuine")
ACCEPT = 0.5
ROUNDS = 40
NEAR = 40

# A dot or separator that joins two parts of a match is first replaced by U+0001, so that each
# match is one run of a character class: Java's matcher recurses on repeated groups and would
# fail on very long ones. The patterns accept the same matches as the fixed forms
#   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card   [0-9]([\x20-]?[0-9])+
#   phone  \+[0-9][\x20().0-9-]+[0-9]
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+\x01-]))[A-Za-z0-9._%+\x01-]++@[A-Za-z0-9-]++\x01"
             r"[A-Za-z0-9\x01-]+",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9\x01])[0-9\x01]{13,}",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "loose": r"(?<![A-Za-z0-9+.-])(?:\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}"
             r"|[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30})(?![A-Za-z0-9-])",
}
#: Cheap tests that every text with a match passes.
_MAY_HAVE = {
    "email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9][ -]?[0-9 -]{11,}[0-9]",
    "phone": "+", "loose": r"[0-9]{3}\)?[ .-]{1,2}[0-9]{2,3}[ .-][0-9]{4}|[A-Z]{2}[0-9]{2}[A-Z0-9]",
}
#: Fixed values of the gazetteer: endings of addresses, issuers' prefixes, private networks.
_ENDINGS = r"(?i)\.(com|org|net|edu|gov|info|io|de|fr|es|uk|it|nl|eu|ch|at|us|ca)$"
_ISSUERS = r"^(4|5[1-5]|2[2-7]|34|37|6011|65|35)"
_RESERVED = r"^(0|10|127|169\.254|172\.(1[6-9]|2[0-9]|3[01])|192\.168|22[4-9]|2[3-5][0-9])\."
_COUNTRY = r"^\+(1|7|2[0-9]|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
_WORDS_BEFORE = {
    "email": "mail|contact|write|@|address", "ip": r"\bip\b|address|host|server|login",
    "card": "card|visa|master|amex|credit|pay|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|cell|telefon|ruf", "ssn": "ssn|social|security",
    "iban": "iban|account|bank|konto|compte|cuenta",
}


def _prepared(kind: str) -> Column:
    """The text, position by position, with joining characters replaced."""
    text = F.col("t")
    if kind == "email":
        return F.regexp_replace(F.translate(text, "\x01", " "),
                                r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", "\x01")
    if kind == "card":
        return F.regexp_replace(F.translate(text, "\x01", "\x02"),
                                r"(?<=[0-9])[ -](?=[0-9])", "\x01")
    return text


def _may_have(kind: str) -> Column:
    hint = _MAY_HAVE[kind]
    return F.col("t").contains(hint) if len(hint) == 1 else F.col("t").rlike(hint)


def matches(docs: DataFrame) -> DataFrame:
    """`doc_id` and for each pattern an array of what it matches: gap, found, before, after.

    `gap` is the number of code points since the match before. Texts without any match keep
    null arrays.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.col("text").cast("string").alias("t"))
    prepared = texts.select("doc_id", *(
        F.when(_may_have(kind), _prepared(kind)).alias(kind) for kind in _PATTERNS))
    cut = prepared.select("doc_id", *(x for kind, pattern in _PATTERNS.items() for x in (
        F.split(kind, pattern, -1).alias(f"{kind}_gaps"),
        F.regexp_extract_all(F.col(kind), F.lit(f"({pattern})"), 1).alias(f"{kind}_found"))))

    def zipped(kind: str) -> Column:
        gaps = f"{kind}_gaps"
        before = F.transform(gaps, lambda g: F.struct(
            F.length(g).cast("bigint").alias("gap"), F.right(g, F.lit(NEAR)).alias("before")))
        after = F.transform(F.slice(gaps, F.lit(2), F.greatest(F.size(gaps) - 1, F.lit(1))),
                            lambda g: F.left(g, F.lit(1)))
        return F.when(F.size(f"{kind}_found") > 0, F.transform(
            F.arrays_zip(F.slice(before, F.lit(1), F.size(f"{kind}_found")).alias("b"),
                         F.col(f"{kind}_found").alias("f"), after.alias("a")),
            lambda z: F.struct(
                z["b"]["gap"].alias("gap"), z["f"].alias("found"),
                z["b"]["before"].alias("before"), z["a"].alias("after"))))

    return cut.select("doc_id", *(zipped(kind).alias(kind) for kind in _PATTERNS))


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _form(kind: Column, found: Column) -> Column:
    """Whether a match has the fixed form of its kind."""
    digits = _digits(found)
    byte = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
    return (
        F.when(kind == "ip", found.rlike(rf"^{byte}\.{byte}\.{byte}\.{byte}$"))
        .when(kind == "card", F.length(digits).between(16, 19) & F.call_function("luhn_check", digits))
        .when(kind == "phone", F.length(digits).between(8, 15))
        .when(kind == "ssn", ~found.rlike("^(000|666|9)|-00-|0000$"))
        .otherwise(F.lit(True)))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _votes(kind: Column, found: Column, before: Column, after: Column, form: Column) -> Column:
    """An array of one vote per labeler."""
    digits = _digits(found)
    gazetteer = (
        F.when(kind == "email", _vote(found.rlike(_ENDINGS), ~found.rlike(_ENDINGS)))
        .when(kind == "ip", _vote(~found.rlike(_RESERVED), found.rlike(_RESERVED)))
        .when(kind == "card", _vote(digits.rlike(_ISSUERS), ~digits.rlike(_ISSUERS)))
        .when((kind == "phone") & found.startswith("+"),
              _vote(found.rlike(_COUNTRY), ~found.rlike(_COUNTRY)))
        .otherwise(0))
    context = F.lit(False)
    for name, words in _WORDS_BEFORE.items():
        context = context | ((kind == name) & before.rlike(f"(?i){words}"))
    number_before = before.rlike(r"[0-9A-Za-z][.,-]?$") & (kind != "email")
    number_after = after.rlike("^[0-9A-Za-z_-]")
    borders = _vote(~number_before & ~number_after, number_before | number_after)
    made_up = digits.rlike(r"^(.)\1*$|^0?123456|^0000") & (kind != "email")
    return F.array(_vote(form, ~form), gazetteer, _vote(context, F.lit(False)), borders,
                   _vote(F.lit(False), made_up))


def candidates(docs: DataFrame) -> DataFrame:
    """`doc_id` and `spans`: kind, start, end, base (whether it is a fixed match), votes."""
    found = materialise(matches(docs), "matches")
    sizes = found.select("doc_id", *_PATTERNS, *(
        F.transform(kind, lambda m: m["gap"] + F.length(m["found"])).alias(f"{kind}_sizes")
        for kind in _PATTERNS))
    placed = sizes.select("doc_id", *(
        F.arrays_zip(F.col(kind).alias("m"), running_sums(f"{kind}_sizes").alias("at")).alias(kind)
        for kind in _PATTERNS))

    def spans(pattern: str) -> Column:
        def span(z: Column) -> Column:
            match = F.translate(z["m"]["found"], "\x01", "." if pattern == "email" else "-")
            kind = F.lit(pattern) if pattern != "loose" else (
                F.when(match.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
                .when(match.rlike("^[A-Z]"), "iban").otherwise("phone"))
            start = z["at"] + z["m"]["gap"]
            form = _form(kind, match)
            return F.struct(
                kind.alias("kind"), start.alias("start"),
                (start + F.length(match)).alias("end"),
                (form if pattern != "loose" else F.lit(False)).alias("base"),
                _votes(kind, match, z["m"]["before"], z["m"]["after"], form).alias("votes"))

        return F.coalesce(F.transform(pattern, span), F.array().cast(
            "array<struct<kind:string,start:bigint,end:bigint,base:boolean,votes:array<int>>>"))

    return placed.select("doc_id", F.concat(*(spans(p) for p in _PATTERNS)).alias("spans"))


def pattern_counts(spans: DataFrame) -> list[Row]:
    """How often each (kind, votes) occurs in all documents: at most 6 * 3**5 rows."""
    return (spans.select(F.explode("spans").alias("s"))
            .groupBy("s.kind", "s.votes").agg(F.count(F.lit(1)).alias("n")).collect())


def reliabilities(patterns: list[tuple[tuple[int, ...], int]],
                  rounds: int = ROUNDS) -> tuple[float, list[dict], dict]:
    """EM for one kind: prior, per labeler P(vote | truth), and P(true) of each vote pattern.

    Starts from labelers that are right more often than not; add-one counts keep every
    probability above zero.
    """
    voters = range(len(LABELERS))
    prior = 0.7
    tables = [{(1, 1): 0.6, (0, 1): 0.3, (-1, 1): 0.1, (1, 0): 0.1, (0, 0): 0.3, (-1, 0): 0.6}
              for _ in voters]
    posterior: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for votes, _n in patterns:
            yes, no = prior, 1 - prior
            for k in voters:
                yes *= tables[k][votes[k], 1]
                no *= tables[k][votes[k], 0]
            posterior[votes] = yes / (yes + no)
        total = sum(n for _, n in patterns)
        mass = sum(n * posterior[v] for v, n in patterns)
        prior = (mass + 1) / (total + 2)
        for k in voters:
            for vote in (-1, 0, 1):
                true = sum(n * posterior[v] for v, n in patterns if v[k] == vote)
                false = sum(n * (1 - posterior[v]) for v, n in patterns if v[k] == vote)
                tables[k][vote, 1] = (true + 1) / (mass + 3)
                tables[k][vote, 0] = (false + 1) / (total - mass + 3)
    return prior, tables, posterior


def train_classifier(patterns: list[tuple[tuple[int, ...], int]],
                     posterior: Mapping[tuple[int, ...], float],
                     rounds: int = 300, rate: float = 0.5) -> dict[tuple[int, int], float]:
    """Weights of a logistic model of the votes, fitted to the posteriors by gradient steps.

    Keys are (labeler, vote), and (-1, 0) for the constant.
    """
    total = sum(n for _, n in patterns) or 1
    weights: dict[tuple[int, int], float] = {(-1, 0): 0.0}
    weights |= {(k, v): 0.0 for k in range(len(LABELERS)) for v in (-1, 1)}
    rows = [([(-1, 0), *((k, v) for k, v in enumerate(votes) if v)], posterior[votes], n / total)
            for votes, n in patterns]
    for _ in range(rounds):
        slope = dict.fromkeys(weights, 0.0)
        for features, target, share in rows:
            score = sum(weights[f] for f in features)
            error = share * (target - 1 / (1 + math.exp(-max(min(score, 30.0), -30.0))))
            for f in features:
                slope[f] += error
        for f in weights:
            weights[f] += rate * 4 * (slope[f] - 1e-4 * weights[f])
    return weights


def fit(rows: list[Row]) -> dict[str, dict[tuple[int, int], float]]:
    """Weights per kind, from the counts of vote patterns."""
    models = {}
    for kind in sorted({r["kind"] for r in rows}):
        patterns = sorted((tuple(r["votes"]), r["n"]) for r in rows if r["kind"] == kind)
        _, _, posterior = reliabilities(patterns)
        models[kind] = train_classifier(patterns, posterior)
    return models


def _probability(models: Mapping[str, Mapping[tuple[int, int], float]], span: Column) -> Column:
    """The classifier as an expression over a span's kind and votes."""
    score = F.lit(None).cast("double")
    for kind, weights in models.items():
        total = F.lit(weights[-1, 0])
        for k in range(len(LABELERS)):
            vote = F.get(span["votes"], F.lit(k))
            total = total + F.when(vote == 1, weights[k, 1]).when(vote == -1, weights[k, -1]) \
                .otherwise(0.0)
        score = F.when(span["kind"] == kind, total).otherwise(score)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def _written(spans: Column) -> Column:
    """kind:start:end in the order of KINDS, then by start, comma-joined."""
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(
        F.array_position(F.array(*(F.lit(k) for k in KINDS)), s["kind"]).alias("rank"),
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ranked, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """Per row: `doc_id`, counts of the base kinds, `base_sha256`, and `spans` with what is added."""
    spans = materialise(candidates(docs), "candidates")
    models = fit(pattern_counts(spans))
    split = spans.select(
        "doc_id", F.filter("spans", lambda s: s["base"]).alias("base"),
        F.filter("spans", lambda s: ~s["base"] & (_probability(models, s) >= accept))
        .alias("more"))
    free = split.select("doc_id", "base", F.filter("more", lambda m: ~F.exists(
        "base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))).alias("more"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return free.select(
        "doc_id", *(count(kind).alias(f"n_{kind}") for kind in BASE_KINDS),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.concat("base", "more")).alias("spans"))
