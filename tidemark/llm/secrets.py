"""Secrets in texts: fixed patterns, and random strings that a tokenizer cannot shorten.

A vocabulary of frequent pieces covers words and paths with few tokens, while a random key needs
about one token for one or two characters. A run of key characters, less the base spans and the
known forms in it (digests, UUIDs, integrity values), falls into parts at its separators. A part
speaks for a key by its characters per token; short parts say nothing, and numbers speak against
it. Neighbouring parts that together have few characters per token are a key if they stretch over
`MIN_KEY` characters, so a key is found after a path, behind an equals sign and next to a base
span, and one that holds separators itself is found whole, while words in between end it.

Offsets count code points. Null and empty texts have no spans. Texts are searched whole,
whatever their length. Every row of the input gives a row, repeated rows too, and columns other
than the id and the text do not matter.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fewer characters per token than this, and parts are taken for random.
CHARACTERS_PER_TOKEN = 2.0
#: A key has so many characters at least; a shorter part of it says nothing.
MIN_KEY, MIN_PART = 18, 4
#: A random string has a separator for so many characters at most; base64 has one for 32.
SEPARATOR_EVERY = 8
#: A part that lowers the sum by more than this is a word, at which a key ends.
WORD_DROP = 3.0
KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_KEY)
_PART = re.compile(r"[A-Za-z0-9]+")
_PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Known forms that are no secrets, wherever they stand alone: the hex digits of common digests
# (MD5, SHA-1, SHA-2), UUIDs, integrity values and repeated characters.
_KNOWN = re.compile(
    r"(?<![A-Za-z0-9])(?:"
    r"(?ai:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12})"
    r"|(?ai:sha(1|256|384|512)-[A-Za-z0-9+/]+)"
    r"|(?:[0-9a-f]+|[0-9A-F]+)(?<=[0-9A-Fa-f]{32})"
    r"|([A-Za-z0-9])\3{7,}"
    r")(?![A-Za-z0-9])")
#: Words in capitals cost many tokens, so those of a constant are judged in small letters.
_CONSTANT = re.compile("[A-Z]+([_-][A-Z0-9]+)+")
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}


@functools.cache
def encoding(path: str) -> tiktoken.Encoding:
    """The encoding of a rank file, loaded once in each Python worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
    return tiktoken.Encoding("ranks", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})


def _known_forms(run: str) -> list[tuple[int, int]]:
    """Where digests, UUIDs and the like stand in a run."""
    return [m.span() for m in _KNOWN.finditer(run)
            if not re.fullmatch("[0-9A-Fa-f]+", m[0]) or len(m[0]) in DIGEST_LENGTHS or m[3]]


def _rest(start: int, end: int, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What of a stretch lies in none of the taken ones, which are in order."""
    for a, b in taken:
        if a > start:
            yield start, min(a, end)
        start = max(start, b)
    if start < end:
        yield start, end


def _weight(part: str, path: str, limit: float) -> float:
    """How far a part has more tokens than words have, in characters; numbers have none."""
    tokens = 0 if part.isdigit() else len(encoding(path).encode_ordinary(part))
    return limit * tokens - len(part)


def random_parts(stretch: str, path: str, limit: float) -> list[tuple[int, int]]:
    """Where neighbouring parts of a stretch need a token for fewer than `limit` characters.

    If there are none, all parts count together, unless they are many short ones.
    """
    constant = _CONSTANT.fullmatch(stretch.strip("=/+_-"))
    parts = [(m.start(), m.end(), _weight(m[0].lower() if constant else m[0], path, limit))
             for m in _PART.finditer(stretch)]
    keys = []
    first, total, best, key = None, 0.0, 0.0, None
    for start, end, weight in parts:
        weight = 0.0 if end - start < MIN_PART else weight
        if first is None or total + weight <= 0 or weight < -WORD_DROP:
            keys += [key] if key else []
            first, total, best, key = start, 0.0, 0.0, None
            if weight <= 0:
                first = None
                continue
        total += weight
        if total >= best:
            best = total
            if end - first >= MIN_KEY:
                key = first, end
    keys += [key] if key else []
    if not keys and parts:
        whole = parts[0][0], parts[-1][1]
        size = whole[1] - whole[0]
        if (size >= MIN_KEY and (len(parts) - 1) * SEPARATOR_EVERY <= size
                and sum(w for _, _, w in parts) > 0):
            keys = [whole]
    return keys


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order."""
    spans = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def all_spans(text: str, base: list[tuple[int, int, int]], path: str,
              limit: float) -> list[tuple[int, int, int]]:
    """The base spans and the random keys in what they leave of the runs."""
    found, i, reaching = [], 0, []
    for m in _RUN.finditer(text):
        start, end = m.span()
        while i < len(base) and base[i][0] < end:
            reaching.append((base[i][0], base[i][2]))
            i += 1
        reaching = [span for span in reaching if span[1] > start]
        known = [(start + a, start + b) for a, b in _known_forms(m[0])]
        for a, b in _rest(start, end, sorted(reaching + known)):
            if b - a >= MIN_KEY:
                found += [(a + x, 3, a + y) for x, y in random_parts(text[a:b], path, limit)]
    return sorted(base + found)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def secret_spans(docs: DataFrame, vocabulary: str = VOCABULARY,
                 characters_per_token: float = CHARACTERS_PER_TOKEN) -> DataFrame:
    """Per row: `doc_id`, counts of the base kinds, `base_sha256`, `spans`, `n_random`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                spans = all_spans(text, base, vocabulary, characters_per_token)
                kinds = [kind for _, kind, _ in spans]
                rows.append((*(kinds.count(k) for k in range(4)),
                             hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
            columns = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names=names)

    names = ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"]
    types = [pa.int64()] * 4 + [pa.string()] * 2
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(
        run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, "
             "base_sha256 string, spans string")


def redact(text: str, vocabulary: str, limit: float, mark: str) -> str:
    """`text` with every secret span replaced by `mark`; overlapping spans by one."""
    out, at = [], 0
    for start, _, end in all_spans(text, base_spans(text), vocabulary, limit):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, vocabulary: str = VOCABULARY,
             characters_per_token: float = CHARACTERS_PER_TOKEN,
             mark: str = "<SECRET>") -> DataFrame:
    """`docs` with the secrets in `text` replaced by `mark`; null texts stay null.

    Where there is a column n_chars, it counts the code points of the new text.
    """
    def run(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in column:
            yield pa.array([None if (t := v.as_py()) is None else
                            redact(t, vocabulary, characters_per_token, mark) for v in values],
                           pa.string())

    new_text = F.arrow_udf(run, "string")
    changed = docs.withColumn("text", new_text(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast("bigint"))
    return changed
