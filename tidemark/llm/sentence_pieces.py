"""Encoding with a SentencePiece model of the merge type by a table of prefixes, and decoding.

In an encoding by merges every prefix of a text has one encoding, so one last token, and a row of
tokens is an encoding exactly if each two neighbours are the encoding of their own text. So the
table keeps, for each prefix, its last token: of the tokens that an Aho-Corasick automaton finds
to end there, the one that is compatible with the last token of the prefix before it. The ids are
read from the end of the table backwards. The work is linear in the text, however long its words.

Whether two tokens are neighbours in an encoding follows from the order in which each of them
grew at the seam: they are not if at any moment a piece across the seam would have come first.
That needs merges of falling priority inside a token; for others the two are merged anew.
Answers are kept, and so are the ids of parts, up to fixed numbers of entries.

No token crosses from one character to the next if no piece has these two next to each other, as
at the ends of words. Texts are cut there first, and the table is made part by part.

The library normalises texts and decodes ids. Null and empty texts give the begin and end ids
alone and decode to an empty text. Repeated rows give repeated rows. Characters outside the
vocabulary become byte pieces, or one unknown id for a run of them in a model without those.
Columns other than the id and the text do not matter. An empty table gives an empty one.
"""

from __future__ import annotations

import functools
import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

#: Entries kept of parts' ids and of pairs' answers; the longest part whose ids are kept.
KEPT_PARTS, KEPT_PAIRS, KEPT_LENGTH = 1 << 18, 1 << 20, 32
#: Characters of a text that are cut at a time.
_PIECE = 1 << 20

Growth = tuple[str, tuple[tuple[float, str], ...]]


class Encoder:
    """The tokens of a model, how each grows at its two ends, and the automaton over them."""

    def __init__(self, model: bytes):
        library = self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        if library.unk_id() < 0:
            raise ValueError("the model has no unknown id")
        ids = range(library.get_piece_size())
        special = {i for i in ids if library.is_unknown(i) or library.is_control(i)
                   or library.is_unused(i) or library.is_byte(i)}
        texts = [library.id_to_piece(i) for i in ids]
        #: Pieces by text, with their id and how late they are merged.
        self.ids = {texts[i]: i for i in ids if i not in special}
        self.late = {t: -library.get_score(i) for t, i in self.ids.items()}
        byte_ids = {texts[i]: i for i in ids if library.is_byte(i)}
        self.byte_ids = [byte_ids.get(f"<0x{b:02X}>") for b in range(256)]
        self.falls_back = None not in self.byte_ids
        self.left: dict[str, Growth] = {}
        self.right: dict[str, Growth] = {}
        self.uneven: set[str] = set()
        self.automaton = ahocorasick.Automaton()
        for token in self.ids.keys() | {c for t in self.ids for c in t}:
            if self._grow(token):
                self.automaton.add_word(token, token)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.parts: dict[str, bytes] = {}
        # Characters of pieces by number, 0 for all others, and which of them are neighbours.
        numbers = {c: n for n, c in enumerate(sorted({c for t in self.ids for c in t}), 1)}
        self.number = np.zeros(0x110000, dtype=np.uint16)
        self.number[[ord(c) for c in numbers]] = list(numbers.values())
        self.neighbours = np.zeros((len(numbers) + 1,) * 2, dtype=bool)
        for token in self.ids:
            for a, b in zip(token, token[1:]):
                self.neighbours[numbers[a], numbers[b]] = True

    def merged(self, text: str) -> Iterator[tuple[float, list[str]]]:
        """Each merge of a short text: how late its piece is, and the pieces afterwards."""
        parts, late = list(text), self.late
        while len(parts) > 1:
            ready = [(late[p], i) for i in range(len(parts) - 1)
                     if (p := parts[i] + parts[i + 1]) in late]
            if not ready:
                return
            when, i = min(ready)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            yield when, parts

    def _grow(self, token: str) -> bool:
        """Notes the first and last pieces of a token as it grows; False if it never gets whole."""
        lefts, rights = [], []
        first, last, before, parts = token[0], token[-1], float("-inf"), list(token)
        for when, parts in self.merged(token):
            if when < before:
                self.uneven.add(token)
            before = when
            if parts[0] != first:
                first = parts[0]
                lefts.append((when, first))
            if parts[-1] != last:
                last = parts[-1]
                rights.append((when, last))
        self.left[token] = (token[0], tuple(lefts))
        self.right[token] = (token[-1], tuple(rights))
        return len(parts) == 1

    def compatible(self, before: str, after: str) -> bool:
        """Whether two tokens are the encoding of their joint text."""
        pair = (before, after)
        answer = self.pairs.get(pair)
        if answer is None:
            if before in self.uneven or after in self.uneven:
                parts = [*pair]
                for _, parts in self.merged(before + after):
                    pass
                answer = parts == [*pair]
            else:
                answer = self._seam_holds(before, after)
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            self.pairs[pair] = answer
        return answer

    def _seam_holds(self, before: str, after: str) -> bool:
        """Follows both sides of the seam through time; equally late merges go left first."""
        never, late = float("inf"), self.late
        (x, rises), (y, falls) = self.right[before], self.left[after]
        i = j = 0
        while True:
            across = late.get(x + y, never)
            on_left = rises[i][0] if i < len(rises) else never
            on_right = falls[j][0] if j < len(falls) else never
            if on_left == on_right == never:
                return across == never
            if on_left <= on_right:
                if across < on_left:
                    return False
                x, i = rises[i][1], i + 1
            else:
                if across <= on_right:
                    return False
                y, j = falls[j][1], j + 1

    def _cut(self, text: str) -> list[str]:
        """The parts of a text between which no token can cross."""
        if len(text) < 2:
            return [text] if text else []
        edges = [0]
        for at in range(0, len(text), _PIECE):
            # With the last character of the piece before.
            first = max(at - 1, 0)
            codes = np.frombuffer(text[first:at + _PIECE].encode("utf-32-le"), np.uint32)
            numbers = self.number[codes]
            edges += (np.flatnonzero(~self.neighbours[numbers[:-1], numbers[1:]])
                      + (first + 1)).tolist()
        return [text[a:b] for a, b in zip(edges, edges[1:] + [len(text)])]

    def _table(self, text: str) -> list[int]:
        """The ids of a part by its table of prefixes."""
        last: list[str | None] = [None] * (len(text) + 1)
        pairs, compatible = self.pairs, self.compatible
        for end, token in self.automaton.iter(text):
            end += 1
            if last[end] is None:
                before = last[end - len(token)]
                # Nothing ends there at the start and after a character no piece has.
                if before is None:
                    last[end] = token
                else:
                    answer = pairs.get((before, token))
                    if answer or answer is None and compatible(before, token):
                        last[end] = token
        ids, at = [], len(text)
        while at:
            token = last[at] or text[at - 1]
            known = self.ids.get(token)
            if known is not None:
                ids.append(known)
            elif self.falls_back:
                ids += [self.byte_ids[b] for b in reversed(token.encode())]
            else:
                ids.append(self.library.unk_id())
            at -= len(token)
        ids.reverse()
        return ids

    def _part(self, part: str) -> bytes:
        ids = array("I", self._table(part)).tobytes()
        if len(part) <= KEPT_LENGTH:
            if len(self.parts) >= KEPT_PARTS:
                self.parts.clear()
            self.parts[part] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text between begin and end id, as little-endian 32-bit integers."""
        known, made = self.parts.get, self._part
        inner = np.frombuffer(b"".join(
            [known(p) or made(p) for p in self._cut(self.library.normalize(text))]),
            np.uint32).astype("<u4")
        if not self.falls_back:
            unknown = inner == self.library.unk_id()
            inner = inner[~(unknown & np.roll(unknown, 1) & (np.arange(len(inner)) > 0))]
        ends = [np.array([i] if i >= 0 else [], "<u4")
                for i in (self.library.bos_id(), self.library.eos_id())]
        return np.concatenate([ends[0], inner, ends[1]])

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


@functools.lru_cache(maxsize=2)
def encoder(model: bytes) -> Encoder:
    """The encoder of a model file, made once in each Python worker."""
    return Encoder(model)


def _chosen(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def _model(docs: DataFrame, path: str):
    """The model file, read by the driver and sent to the executors once; some 500 kB."""
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """Per row `doc_id`, `ids` with begin and end id, and `decoded`, the text they stand for."""
    model = _model(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(model.value)
        for batch in batches:
            for row in range(batch.num_rows):
                ids = tool.encode(batch.column(1)[row].as_py() or "")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, 1),
                     pa.array([ids.astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([tool.decode(ids)], pa.string())], ["doc_id", "ids", "decoded"])

    return _chosen(docs).mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row `doc_id`, `n_tokens`, `ids_sha256`, `decoded_sha256`, without moving any ids.

    `ids_sha256` is of the ids as little-endian unsigned 32-bit integers, `decoded_sha256` of
    the decoded text in UTF-8.
    """
    model = _model(docs, path)

    def digest(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(model.value)
        for batch in batches:
            counts, of_ids, of_texts = [], [], []
            for value in batch.column(1):
                ids = tool.encode(value.as_py() or "")
                counts.append(len(ids))
                of_ids.append(digest(ids.tobytes()))
                of_texts.append(digest(tool.decode(ids).encode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                 pa.array(of_texts, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _chosen(docs).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
