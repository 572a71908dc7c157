"""Licence notices in texts.

One Aho-Corasick automaton runs over the words of a text and finds every notice phrase and
every licence tag in a single pass. Where it meets an identifier tag, the expression behind it
is read from the text and evaluated with a shunting-yard parser: `with` binds tighter than
`and`, `and` tighter than `or`; brackets group. Identifiers of no known family are labels by their own
lower-cased names, and whether they allow reuse stays open.

A text's words are runs of a-z, 0-9 and characters from U+0080 after lower-casing A-Z, so
phrases are found across punctuation and line ends. Places are counted whether or not they
overlap. Null and empty texts have no words, no labels and score 0. Whole texts are searched.
Every row gives a row, repeated rows too; other columns do not matter.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import utf8

#: Phrases that name a licence, the label of each, and how strong a sign it is.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
NOTICE_PHRASES = {
    "mit license": ("mit", 0.9),
    "permission is hereby granted free of charge": ("mit", 0.9),
    "apache license": ("apache", 0.9),
    "bsd license": ("bsd", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "lesser general public license": ("lgpl", 0.9),
    "affero general public license": ("agpl", 0.9),
    "cc by nc": ("cc-by-nc", 0.9),
    "cc by sa": ("cc-by-sa", 0.9),
    "cc by nd": ("cc-by-nd", 0.9),
    "cc0": ("cc0", 0.8),
    "public domain": ("public-domain", 0.5),
    "creative commons attribution": ("cc-by", 0.9),
    "the unlicense": ("unlicense", 0.8),
}
BASE_STRENGTH = {"cc-by": 0.8, "gpl": 0.9, "reserved": 0.7}
TAG = "spdx license identifier"
#: Identifiers by their first part, the label of each, and whether reuse is allowed.
IDENTIFIERS = {
    "mit": ("mit", True), "apache": ("apache", True), "bsd": ("bsd", True),
    "isc": ("isc", True), "zlib": ("zlib", True), "unlicense": ("unlicense", True),
    "cc0": ("cc0", True), "cc-by-nc": ("cc-by-nc", False), "cc-by-nd": ("cc-by-nd", False),
    "cc-by-sa": ("cc-by-sa", True), "cc-by": ("cc-by", True), "mpl": ("mpl", True),
    "lgpl": ("lgpl", False), "agpl": ("agpl", False), "gpl": ("gpl", False),
}

_NOT_WORD = bytes(c for c in range(128) if not (chr(c).isdigit() or "a" <= chr(c) <= "z"))
_TO_WORDS = bytes.maketrans(_NOT_WORD, b" " * len(_NOT_WORD))
_TAG = re.compile(rb"spdx-license-identifier:")
_EXPRESSION = re.compile(rb"[a-z0-9.+() \t-]*")
_TOKEN = re.compile(r"[()]|[a-z0-9.+-]+")
_NAME = re.compile("[a-z0-9]")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def identifier(name: str) -> tuple[str, bool] | None:
    """Label and permission of an identifier such as gpl-3.0-or-later."""
    parts = name.rstrip("+").split("-")
    for n in range(len(parts), 0, -1):
        if known := IDENTIFIERS.get("-".join(parts[:n])):
            return known
    return None


def to_postfix(expression: str) -> list[str] | None:
    """The tokens of a licence expression in postfix order, or None if it is malformed.

    What follows a complete expression in running text is not part of it.
    """
    output: list[str] = []
    operators: list[str] = []
    operand_next = True
    for token in _TOKEN.findall(expression):
        if token == "(":
            if not operand_next:
                break
            operators.append(token)
        elif token == ")":
            if operand_next or "(" not in operators:
                break
            while operators[-1] != "(":
                output.append(operators.pop())
            operators.pop()
        elif token in _PRECEDENCE:
            if operand_next:
                return None
            while (operators and operators[-1] != "("
                   and _PRECEDENCE[operators[-1]] >= _PRECEDENCE[token]):
                output.append(operators.pop())
            operators.append(token)
            operand_next = True
        else:
            if not operand_next:
                break
            output.append(token)
            operand_next = False
    if operand_next or "(" in operators:
        return None
    return output + operators[::-1]


def evaluate(expression: str) -> tuple[set[str], bool | None]:
    """Labels that an expression names, and whether it lets the text be reused.

    `or` leaves the choice, `and` asks for both, `with` adds an exception that does not take a
    permission away. Unknown identifiers give no label here and leave the answer open (None).
    """
    labels, _, allowed = _evaluated(expression)
    return labels, allowed


def both(left: bool | None, right: bool | None) -> bool | None:
    """Three-valued `and`."""
    return False if False in (left, right) else None if None in (left, right) else True


def _evaluated(expression: str) -> tuple[set[str], set[str], bool | None]:
    """Like `evaluate`, with the unknown identifiers in between."""
    postfix = to_postfix(expression)
    if postfix is None:
        return set(), set(), None
    labels: set[str] = set()
    unknown: set[str] = set()
    stack: list[bool | None] = []
    for i, token in enumerate(postfix):
        if token not in _PRECEDENCE:
            known = identifier(token)
            is_exception = i + 1 < len(postfix) and postfix[i + 1] == "with"
            if known and not is_exception:
                labels.add(known[0])
            elif not is_exception and _NAME.search(token):
                unknown.add(token)
            stack.append(known[1] if known else None)
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            stack.append(left)
        elif token == "or":
            stack.append(True if True in (left, right) else
                         None if None in (left, right) else False)
        else:
            stack.append(both(left, right))
    return labels, unknown, stack[0]


@functools.cache
def automaton() -> ahocorasick.Automaton:
    words = ahocorasick.Automaton()
    for phrase in [*BASE_PHRASES, *NOTICE_PHRASES, TAG]:
        words.add_word(f" {phrase} ", phrase)
    words.make_automaton()
    return words


def scan(text: bytes | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, expression, reusable."""
    lowered = text.lower() if text else b""
    words = lowered.translate(_TO_WORDS).split()
    # Latin-1 maps bytes to characters one by one; every phrase is ASCII.
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
    starts, base, strength, expressions = [], set(), {}, []
    at = place = 0
    tagged = False
    for end, phrase in automaton().iter(joined):
        if phrase == TAG:
            tagged = True
        elif phrase in BASE_PHRASES:
            label = BASE_PHRASES[phrase]
            begin = end - len(phrase) - 1
            # Matches come by their end; a longer one may begin before the last one.
            place = place + joined.count(" ", at, begin) if begin >= at else \
                place - joined.count(" ", begin, at)
            at = begin
            starts.append(place)
            base.add(label)
            strength[label] = max(strength.get(label, 0.0), BASE_STRENGTH[label])
        else:
            label, value = NOTICE_PHRASES[phrase]
            strength[label] = max(strength.get(label, 0.0), value)
    reusable = None
    if tagged:
        for tag in _TAG.finditer(lowered):
            expression = _EXPRESSION.match(lowered, tag.end())[0].decode("ascii").strip()
            labels, unknown, allowed = _evaluated(expression)
            for label in labels | unknown:
                strength[label] = 1.0
            expressions.append(expression)
            reusable = both(reusable, allowed) if len(expressions) > 1 else allowed
    doubt = 1.0
    for value in sorted(strength.values()):
        doubt *= 1.0 - value
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(strength)), 1.0 - doubt,
            next(filter(None, expressions), None), reusable)


_COLUMNS = [("n_words", "bigint", pa.int64()), ("n_base", "bigint", pa.int64()),
            ("first_word", "bigint", pa.int64()), ("last_word", "bigint", pa.int64()),
            ("base_labels", "string", pa.string()), ("labels", "string", pa.string()),
            ("score", "double", pa.float64()), ("expression", "string", pa.string()),
            ("reusable", "boolean", pa.bool_())]


def license_scan(docs: DataFrame) -> DataFrame:
    """Per row: `doc_id` and what `scan` finds in its `text`.

    `score` is the probability that some sign is right, taking the signs as independent;
    `expression` is the first tag's, malformed or not. `reusable` says whether every tag in the text
    allows reuse (null: none, or unknown for one and refused by none).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan(text) for text in utf8(batch.column(1))]
            columns = list(zip(*rows)) if rows else [[]] * len(_COLUMNS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, (_, _, t) in zip(columns, _COLUMNS))],
                names=["doc_id", *(name for name, _, _ in _COLUMNS)])

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(
        run, "doc_id bigint, " + ", ".join(f"{name} {kind}" for name, kind, _ in _COLUMNS))
