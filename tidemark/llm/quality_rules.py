"""Host-level quality rules, with DataFrame functions only.

Every document is tested by rules. Failures are counted per host and rule, and the failure
rates of the hosts are shrunk: a Beta prior is fitted to the counts of all hosts by the moments
of the beta-binomial, which tell how much hosts differ beyond the chance of their few documents.
So a host with few documents stays near the common rate, the nearer the more alike hosts are. A
host whose shrunk rate exceeds the limit of a rule is rejected, and its verdict is joined back to
its documents.

A null text has no words (and fails by length); a null host is a host of its own. Repeated rows
count as often as they occur. Columns other than id, text and host do not matter. An empty table
gives an empty table. Texts are read whole; a document's words are held in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import WORD, join_small
from tidemark.session import materialise

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW_WORDS = 3
#: What else a document may fail by, as shares of its words or lines.
SYMBOLS_PER_WORD = 0.1
DUPLICATE_LINES = 0.3
WORD_LENGTH = (2.0, 20.0)
#: A host is rejected if more than this share of its documents fails a rule, after shrinking.
HOST_LIMITS = {"short": 0.8, "repeated": 0.5, "symbols": 0.5, "lines": 0.5, "length": 0.5}
#: The least and the greatest weight of the prior, in documents.
STRENGTHS = (2.0, 1e6)
SYMBOLS = "[#*$%&|<>]"


def document_measures(docs: DataFrame, host: str = "source") -> DataFrame:
    """`doc_id`, `host` and the measures that the rules look at, one row per document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col(host).cast("string").alias("host"), text.alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda line: line.rlike(WORD))
    worded = base.select(
        "doc_id", "host",
        F.regexp_extract_all("t", F.lit(f"({WORD})"), 1).alias("words"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        lines.alias("lines"))
    counted = worded.select(
        "doc_id", "host", "n_symbols", "words",
        F.size("words").cast("bigint").alias("n_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"))
    # Windows are compared by 64-bit hashes. Texts without a repeated window, the most, cost one
    # hash set; in the others the windows are sorted by hash, so that equal ones are neighbours.
    hashed = counted.select(
        "*", F.when(F.col("n_words") >= WINDOW_WORDS, F.transform(
            F.sequence(F.lit(0), F.size("words") - WINDOW_WORDS),
            lambda i: F.xxhash64(*(F.get("words", i + j) for j in range(WINDOW_WORDS)))))
        .alias("hashes")).drop("words")
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    ordered = hashed.select("*", F.when(repeats, F.array_sort(F.transform(
        "hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("ordered")
        ).drop("hashes")
    again = F.filter(F.transform("ordered", lambda w, k: F.when(
        (F.get("ordered", k - 1)["h"] == w["h"]) | (F.get("ordered", k + 1)["h"] == w["h"]),
        w["i"])), lambda i: i.isNotNull())
    found = ordered.select("*", again.alias("again")).drop("ordered")
    covered = F.array_distinct(F.flatten(F.transform(
        "again", lambda i: F.array(*(i + j for j in range(WINDOW_WORDS))))))
    return found.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.coalesce(F.size(covered).cast("bigint"), F.lit(0).cast("bigint"))
        .alias("n_repeat_words"))


def rule_failures() -> dict[str, Column]:
    """The rules over the columns of `document_measures`."""
    words = F.col("n_words")
    mean_length = F.try_divide("word_chars", words)
    return {
        "short": words < MIN_WORDS,
        "repeated": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * words,
        "symbols": F.col("n_symbols") > SYMBOLS_PER_WORD * words,
        "lines": F.col("n_dup_lines") > DUPLICATE_LINES * F.col("n_lines"),
        "length": F.coalesce(~mean_length.between(*WORD_LENGTH), F.lit(False)),
    }


def prior_strength(mean: float, excess: float, hosts: int, docs: int, limit: float) -> float:
    """The weight of the prior in documents: with a common rate m, it is Beta(m*s, (1-m)*s).

    `excess` is the sum over hosts of n * (rate - m)**2. If hosts differed by chance only, it
    would be m(1-m) * (hosts - 1); each further document of a host adds m(1-m) times the share r
    of the variance that lies between hosts, and s = 1/r - 1. Hosts of one document say nothing
    about r: if there are no others, or they differ less than by chance, s is the greatest.

    It is at least what keeps a host with a single document at or below the limit, so one
    document alone never rejects its host while the common rate is below the limit.
    """
    least, most = STRENGTHS
    chance = mean * (1 - mean)
    between = (excess / chance - (hosts - 1)) / (docs - hosts) if chance and docs > hosts else 0.0
    strength = 1 / between - 1 if between > 0 else most
    if mean < limit:
        least = max(least, (1 - limit) / (limit - mean))
    return min(max(strength, least), max(most, least))


def host_rates(measures: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """`host`, `n_docs` and per rule the failures and the shrunk rate of each host."""
    rules, limits = rule_failures(), limits or HOST_LIMITS
    hosts = materialise(measures.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *(F.count_if(test).alias(f"{rule}_failures") for rule, test in rules.items())), "hosts")
    seen = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.sum("n_docs").alias("docs"), *(
        x for rule in rules for x in (
            F.sum(f"{rule}_failures").alias(f"{rule}_sum"),
            F.sum(F.col(f"{rule}_failures") * F.col(f"{rule}_failures") / F.col("n_docs"))
            .alias(f"{rule}_squares")))).first()

    def shrunk(rule: str) -> Column:
        docs = seen["docs"] or 0
        mean = seen[f"{rule}_sum"] / docs if docs else 0.0
        excess = seen[f"{rule}_squares"] - docs * mean * mean if docs else 0.0
        strength = prior_strength(mean, excess, seen["hosts"], docs, limits.get(rule, 1.0))
        return ((F.col(f"{rule}_failures") + mean * strength)
                / (F.col("n_docs") + strength)).alias(f"{rule}_rate")

    return hosts.select("*", *(shrunk(rule) for rule in rules))


def judged(docs: DataFrame, host: str = "source",
           limits: dict[str, float] | None = None) -> DataFrame:
    """Per row: the measures, `base_failed`, `host_failed` and `kept`."""
    measures = materialise(document_measures(docs, host), "document_measures")
    rates = host_rates(measures, limits)
    over = F.lit(False)
    for rule, limit in (limits or HOST_LIMITS).items():
        over = over | (F.col(f"{rule}_rate") > limit)
    verdicts = rates.select("host", over.alias("host_failed"))
    rules = rule_failures()
    base_failed = rules["short"] | rules["repeated"]
    joined = join_small(measures, verdicts, "host", rates.count())
    return joined.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), "host_failed",
        (~base_failed & ~F.col("host_failed")).alias("kept"))
