"""A hierarchical Pitman-Yor language model, sampled over the cluster.

The context of a token is the word before it, known by its last byte, folded to 64 symbols, and
10 bits of its hash, so there are 65,536 context restaurants. Those whose words end alike share
one of 64 parent restaurants, which share the root, whose base is uniform over the V known words
and one unknown word. Customers of a context restaurant are the training tokens that follow it;
every table of a restaurant is a customer of its parent.

The seating is sampled by Gibbs sweeps. A sweep draws the number of tables of every dish in
every restaurant given the probabilities of its parent and the totals of a run of sweeps before,
the same for all sweeps of a run: with c customers, t tables have probability proportional to S(c, t) * a**t, where S is a generalised
Stirling number (all seatings of c customers at t tables) and a the weight of a new table. From
WHOLE customers on, the rest are seated one after another, skipping to the next one that opens
a table. A text's probability is the mean of the predictive probabilities over the samples; the
totals of each sample are exact, so the probabilities of a context sum to one.

How it is spread out: a dish (a word) lives in one shard with all of its restaurants, so seating
needs only the totals of the restaurants from elsewhere, 65,601 numbers. Documents are cut into
blocks of text. A block counts its different (word, context) pairs and sends each once, so a hot
word costs a row per block at most. A shard's requests are united some FAN_IN at a time, level by
level, so no task holds those of all blocks, however hot a word. The shards answer with a
probability for each pair, the answers go down the same levels, and the blocks score their
documents. Columns of numbers travel compressed. Blocks, counts and seatings
are written tables, so a lost executor costs its own tasks.

Words are told apart by 48 bits of a hash. Null and empty texts have one token, the end. A
document without an id is trained on. Repeated rows are trained on and scored as often as they
occur. Other columns do not matter. If no text is trained on, every token is the unknown word.
An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Row, functions as F

from tidemark.llm.common import BLANKS, FOLD, utf8, words_of
from tidemark.session import materialise

FOLDS = 7
HELD_OUT = 2
#: Bits of a context: those of the hash of the word before, below the symbol of its last byte.
HASH_BITS, SYMBOL_BITS = 10, 6
CONTEXT_BITS = HASH_BITS + SYMBOL_BITS
CONTEXTS, PARENTS = 1 << CONTEXT_BITS, 1 << SYMBOL_BITS
STRENGTH = 1.0
BURN_IN, SAMPLES = 3, 4
WHOLE = 64
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 8 << 20
FAN_IN = 64
SEED = 11

_END = np.uint64(0x9F4E0D5C31B7A268)
_PAIR_SHIFT = np.uint64(CONTEXT_BITS)
_GROUP_SHIFT = np.uint64(HASH_BITS)
_LOW = np.uint64(CONTEXTS - 1)


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes; sorted 64-bit keys as their differences."""
    if values.dtype == np.uint64:
        values = np.diff(values, prepend=np.uint64(0))
    # Bytes of equal weight side by side compress better.
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, kind: str) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    values = planes.reshape(kind.itemsize, -1).T.copy().view(kind).reshape(-1)
    return np.cumsum(values, dtype=np.uint64) if kind == np.uint64 else values


def pair_keys(text: bytes | None) -> np.ndarray:
    """For each token its word's hash, with the context in the low bits."""
    hashes, tails = words_of(text.lower() if text else b"", BLANKS)
    before = FOLD[tails >> 8].astype(np.uint64) << _GROUP_SHIFT | hashes >> np.uint64(64 - HASH_BITS)
    words = np.r_[hashes, _END] >> _PAIR_SHIFT << _PAIR_SHIFT
    return words | np.r_[np.uint64(0), before]


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


_BLOCKS = "block bigint, shard int, keys binary, counts binary, ids array<bigint>, " \
          "held array<boolean>, sizes binary, tokens binary"


def blocks_of(docs: DataFrame, shards: int) -> DataFrame:
    """Rows of two kinds: requests (shard, keys, counts), and the documents of a block (shard -1).

    A block's keys are sorted, as are its shards, so the answers of the shards in order give a
    value for each key. `tokens` are the places of each document's keys, sorted, as differences.
    """
    from pyspark import TaskContext

    names = [field.split()[0] for field in _BLOCKS.split(", ")]
    types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()),
             pa.list_(pa.bool_()), pa.binary(), pa.binary()]

    def finish(block: int, ids: list, held: list, keys: list) -> pa.RecordBatch:
        sizes = np.fromiter(map(len, keys), dtype=np.int32, count=len(keys))
        everything = np.concatenate(keys)
        distinct, place = np.unique(everything, return_inverse=True)
        trained = np.repeat(~np.array(held), sizes)
        counts = np.bincount(place[trained], minlength=len(distinct)).astype(np.int64)
        tokens = np.empty(len(everything), dtype=np.int32)
        at = 0
        for size in sizes.tolist():
            tokens[at:at + size] = np.diff(np.sort(place[at:at + size]), prepend=0)
            at += size
        shard = _shard_of(distinct, shards)
        firsts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
        ends = np.r_[firsts[1:], len(distinct)]
        rows = [(block, int(shard[a]), packed(distinct[a:b]), packed(counts[a:b]),
                 None, None, None, None) for a, b in zip(firsts, ends)]
        rows.append((block, -1, None, None, ids, held, packed(sizes), packed(tokens)))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, held, keys, size = [], [], [], 0
        for batch in batches:
            for doc, out, text in zip(batch.column(0), batch.column(1), utf8(batch.column(2))):
                ids.append(doc.as_py())
                held.append(out.as_py())
                keys.append(pair_keys(text))
                size += len(text or b"")
                if size >= BLOCK_BYTES:
                    yield finish(block, ids, held, keys)
                    block, ids, held, keys, size = block + 1, [], [], [], 0
        if ids:
            yield finish(block, ids, held, keys)

    remainder = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS, F.lit(0))
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         (remainder == HELD_OUT).alias("held"),
                         F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, _BLOCKS)


@dataclass(frozen=True)
class Totals:
    """Customers and tables of every restaurant: contexts, parents and root."""

    customers: tuple[np.ndarray, np.ndarray, float]
    tables: tuple[np.ndarray, np.ndarray, float]

    @staticmethod
    def of(flat: np.ndarray) -> Totals:
        half = CONTEXTS + PARENTS + 1
        return Totals(*((p[:CONTEXTS], p[CONTEXTS:-1], float(p[-1]))
                        for p in (flat[:half], flat[half:])))


@dataclass(frozen=True)
class Model:
    """What all shards share: discounts (contexts, parents, root), V, and the totals."""

    discounts: tuple[float, float, float]
    vocabulary: int
    totals: Totals


class Shard:
    """The dishes of a shard: pairs sorted by word and context, with counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts.astype(np.int64)
        self.context = (keys & _LOW).astype(np.int64)
        group = keys >> _GROUP_SHIFT
        word = keys >> _PAIR_SHIFT
        self.group_first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        self.word_first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        self.group = np.cumsum(np.r_[False, group[1:] != group[:-1]])
        self.group_word = np.cumsum(np.r_[False, word[1:] != word[:-1]])[self.group_first]
        self.parent = self.context[self.group_first] >> HASH_BITS
        self.word_group_first = np.flatnonzero(
            np.r_[True, self.group_word[1:] != self.group_word[:-1]])
        self.word_counts = np.add.reduceat(self.counts, self.word_first)

    def by_group(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.group_first)

    def by_word(self, group_values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(group_values, self.word_group_first)

    def seating(self) -> Seating:
        """Everyone who eats a dish in a restaurant at one table."""
        tables = np.minimum(self.counts, 1)
        group_tables = np.minimum(self.by_group(tables), 1)
        return Seating(self, tables, group_tables, np.minimum(self.by_word(group_tables), 1))


@dataclass
class Seating:
    shard: Shard
    tables: np.ndarray
    group_tables: np.ndarray
    root_tables: np.ndarray

    def totals(self) -> np.ndarray:
        """Customers and tables of the shard's dishes, as one flat array per restaurant."""
        s = self.shard
        parts = []
        for values, group_values, root in (
                (s.counts, s.by_group(self.tables), s.by_word(self.group_tables)),
                (self.tables, self.group_tables, self.root_tables)):
            parts += [np.bincount(s.context, weights=values, minlength=CONTEXTS),
                      np.bincount(s.parent, weights=group_values, minlength=PARENTS),
                      [float(root.sum())]]
        return np.concatenate(parts)

    def probabilities(self, model: Model, totals: Totals) -> tuple[np.ndarray, ...]:
        """Predictive probabilities of the pairs, the (word, parent) groups and the words."""
        s, (d2, d1, d0) = self.shard, model.discounts
        (c2, c1, c0), (t2, t1, t0) = totals.customers, totals.tables
        root = (s.by_word(self.group_tables) - d0 * self.root_tables
                + (STRENGTH + d0 * t0) / (model.vocabulary + 1)) / (STRENGTH + c0)
        group = (s.by_group(self.tables) - d1 * self.group_tables
                 + (STRENGTH + d1 * t1)[s.parent] * root[s.group_word]
                 ) / (STRENGTH + c1)[s.parent]
        pair = (s.counts - d2 * self.tables + (STRENGTH + d2 * t2)[s.context] * group[s.group]
                ) / (STRENGTH + c2)[s.context]
        return pair, group, root

    def sweep(self, model: Model, rng: np.random.Generator) -> Seating:
        s, (d2, d1, d0), (t2, t1, t0) = self.shard, model.discounts, model.totals.tables
        _, group, root = self.probabilities(model, model.totals)
        tables = draw_tables(s.counts, (STRENGTH + d2 * t2)[s.context] * group[s.group], d2, rng)
        group_tables = draw_tables(s.by_group(tables),
                                   (STRENGTH + d1 * t1)[s.parent] * root[s.group_word], d1, rng)
        base = (STRENGTH + d0 * t0) / (model.vocabulary + 1)
        customers = s.by_word(group_tables)
        return Seating(s, tables, group_tables,
                       draw_tables(customers, np.full(len(customers), base), d0, rng))


def log_stirling(most: int, discount: float) -> np.ndarray:
    """log S(c, t) for c and t up to `most`: S(c+1, t) = S(c, t-1) + (c - discount*t) S(c, t)."""
    table = np.full((most + 1, most + 1), -np.inf)
    table[0, 0] = 0.0
    table[1, 1] = 0.0
    t = np.arange(most + 1)
    for c in range(1, most):
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = table[c] + np.where(c > discount * t, np.log(np.maximum(c - discount * t, 1e-300)),
                                       -np.inf)
        table[c + 1] = np.logaddexp(stay, np.r_[-np.inf, table[c, :-1]])
    return table


def draw_tables(customers: np.ndarray, weight: np.ndarray, discount: float,
                rng: np.random.Generator) -> np.ndarray:
    """Numbers of tables at which `customers` sit, given the weight of a new table."""
    tables = np.minimum(customers, 1)
    several = np.flatnonzero(customers > 1)
    if not len(several):
        return tables
    logs = log_stirling(WHOLE, discount)
    first = np.minimum(customers[several], WHOLE)
    order = np.argsort(first, kind="stable")
    bounds = np.searchsorted(first[order], np.arange(2, WHOLE + 2))
    for c, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]), 2):
        for at in range(a, b, 1 << 15):
            rows = several[order[at:min(b, at + (1 << 15))]]
            t = np.arange(1, c + 1)
            score = logs[c, 1:c + 1] + np.log(weight[rows])[:, None] * t
            tables[rows] = 1 + np.argmax(score + rng.gumbel(size=score.shape), axis=1)
    # Those beyond: the next to open a table comes after a waiting time with a closed form.
    rows = np.flatnonzero(customers > WHOLE)
    seated = np.full(len(rows), float(WHOLE))
    while len(rows):
        shift = (weight[rows] - 1) / 2 - discount * tables[rows]
        with np.errstate(over="ignore"):
            seated = (seated + shift) * rng.random(len(rows)) ** (-1 / weight[rows]) - shift
        seated = np.floor(seated) + 1
        more = seated <= customers[rows]
        rows, seated = rows[more], seated[more]
        tables[rows] += 1
    return tables


_STATE = "shard int, keys binary, counts binary, blocks array<bigint>, places array<binary>, " \
         "totals array<double>, seen array<bigint>"


_UNITED = "shard int, block bigint, keys binary, counts binary, blocks array<bigint>, " \
          "places array<binary>"


def _united(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The union of the requested keys, their counts, and where the keys of each request lie."""
    keys = [unpacked(k, "u8") for k in table["keys"].to_pylist()]
    counts = [unpacked(c, "i8") for c in table["counts"].to_pylist()]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate(counts), minlength=len(distinct)) \
        .astype(np.int64)
    places, at = [], 0
    for part in keys:
        places.append(packed(np.diff(place[at:at + len(part)], prepend=0).astype(np.int32)))
        at += len(part)
    return distinct, total, places


def _unite(table: pa.Table) -> pa.Table:
    """Some requests to a shard as one."""
    distinct, total, places = _united(table)
    row = [table["shard"][0].as_py(), table["union"][0].as_py(), packed(distinct), packed(total),
           table["block"].to_pylist(), places]
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()),
             pa.list_(pa.binary())]
    return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(row, types)],
                                names=[f.split()[0] for f in _UNITED.split(", ")])


def united_requests(requests: DataFrame, blocks: int) -> list[DataFrame]:
    """The levels of united requests, until those of some FAN_IN blocks or unions are left."""
    levels = []
    while blocks > FAN_IN:
        blocks = -(-blocks // FAN_IN)
        levels.append(materialise(
            requests.withColumn("union", F.pmod(F.xxhash64("block"), F.lit(blocks)))
            .groupBy("shard", "union").applyInArrow(_unite, _UNITED), "united_requests"))
        requests = levels[-1].select("shard", "block", "keys", "counts")
    return levels


def _gather(table: pa.Table) -> pa.Table:
    """One shard: the union of the requested keys with their counts, and who asked for which."""
    distinct, total, places = _united(table)
    shard = Shard(distinct, total)
    seating = shard.seating()
    seen = [int(np.count_nonzero(shard.word_counts)), int(total.sum())]
    for values in (total, shard.by_group(seating.tables), shard.by_word(seating.group_tables)):
        seen += [int(np.count_nonzero(values == 1)), int(np.count_nonzero(values == 2))]
    row = [table["shard"][0].as_py(), packed(distinct), packed(total), table["block"].to_pylist(),
           places, seating.totals().tolist(), seen]
    types = [pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary()),
             pa.list_(pa.float64()), pa.list_(pa.int64())]
    return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(row, types)],
                                names=[f.split()[0] for f in _STATE.split(", ")])


def _summed(rows: DataFrame, column: str) -> np.ndarray:
    """The sum over rows of an array column; its length does not depend on the input."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kind = 0, None
        for batch in batches:
            kind = batch.schema.types[0]
            for values in batch.column(0):
                total = total + values.values.to_numpy(zero_copy_only=False)
        if kind is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], kind)], names=["v"])

    kind = rows.schema[column].dataType.simpleString()
    sums = rows.select(column).mapInArrow(run, f"v {kind}").select(F.posexplode("v")) \
        .groupBy("pos").agg(F.sum("col").alias("v")).toArrow()
    found = np.zeros(sums.num_rows, dtype=sums["v"].to_numpy().dtype)
    found[sums["pos"].to_numpy()] = sums["v"].to_numpy()
    return found


def _samples(row: dict, model: Model) -> Iterator[Seating]:
    """The seatings of one shard after the burn-in; the same on every call."""
    rng = np.random.default_rng([SEED, row["shard"]])
    seating = Shard(unpacked(row["keys"], "u8"), unpacked(row["counts"], "i8")).seating()
    for sweep in range(BURN_IN + SAMPLES):
        seating = seating.sweep(model, rng)
        if sweep >= BURN_IN:
            yield seating


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def sampled_totals(state: DataFrame, model: Model) -> np.ndarray:
    """The totals of every sample, over all shards: SAMPLES rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            flat = np.concatenate([s.totals() for s in _samples(row, model)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([flat], pa.list_(pa.float64()))], names=["totals"])

    totals = state.select("shard", "keys", "counts").mapInArrow(run, "totals array<double>")
    return _summed(totals, "totals").reshape(SAMPLES, -1)


_REPLIES = "block bigint, shard int, logs binary, known binary"


def _replies(shard: int, blocks: list[int], places: list[bytes], logs: np.ndarray,
             known: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What each of the blocks asked for, out of the values for the union of their keys."""
    for block, place in zip(blocks, places):
        at = np.cumsum(unpacked(place, "i4"))
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([shard], pa.int32()),
             pa.array([packed(logs[at])], pa.binary()), pa.array([packed(known[at])], pa.binary())],
            names=[f.split()[0] for f in _REPLIES.split(", ")])


def answers(state: DataFrame, model: Model, totals: np.ndarray) -> DataFrame:
    """For each request, the log10 probability of each pair and the count of its word."""
    each = [Totals.of(t) for t in totals]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            mean = 0.0
            for seating, exact in zip(_samples(row, model), each):
                mean = mean + seating.probabilities(model, exact)[0]
            shard = seating.shard
            logs = np.log10(mean / len(each)).astype(np.float32)
            counts = np.repeat(shard.word_counts, np.diff(np.r_[shard.word_first, len(logs)]))
            yield from _replies(row["shard"], row["blocks"], row["places"], logs, counts)

    return state.select("shard", "keys", "counts", "blocks", "places").mapInArrow(run, _REPLIES)


def handed_down(replies: DataFrame, united: DataFrame) -> DataFrame:
    """The answers to the requests that were united, out of the answers to the unions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            yield from _replies(row["shard"], row["blocks"], row["places"],
                                unpacked(row["logs"], "f4"), unpacked(row["known"], "i8"))

    asked = united.select("shard", "block", "blocks", "places")
    return asked.join(replies, ["shard", "block"]).select(
        "shard", "blocks", "places", "logs", "known").mapInArrow(run, _REPLIES)


def _score(trained: int, vocabulary: int):
    """Scores the documents of a block, given the answers for its keys."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(documents: pa.Table, replies: pa.Table) -> pa.Table:
        replies = replies.sort_by("shard")
        logs = np.concatenate([unpacked(x, "f4") for x in replies["logs"].to_pylist()])
        known = np.concatenate([unpacked(x, "i8") for x in replies["known"].to_pylist()])
        base = np.log10((known + 1.0) / (trained + vocabulary + 1.0))
        row = documents.to_pylist()[0]
        sizes, gaps = unpacked(row["sizes"], "i4"), unpacked(row["tokens"], "i4")
        results, at = [], 0
        for doc, held, size in zip(row["ids"], row["held"], sizes.tolist()):
            place = np.cumsum(gaps[at:at + size])
            at += size
            results.append((doc, held, size, int(np.count_nonzero(known[place])),
                            float(base[place].sum()),
                            float(logs[place].sum(dtype=np.float64))))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*results), types)],
                                    names=names)

    return run


def _model(first: Row | None, totals: np.ndarray) -> Model:
    def discount(ones: int, twos: int) -> float:
        return min(max(ones / (ones + 2 * twos), 0.1), 0.95) if ones and twos else 0.5

    pairs = [first[i:i + 2] for i in (2, 4, 6)]
    return Model(tuple(discount(*p) for p in pairs), int(first[0]), Totals.of(totals))


def document_scores(docs: DataFrame) -> DataFrame:
    """Per row: `doc_id`, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`.

    `score` is the model's log10 probability of the text; `base_score` that of single words with
    one added to each count.
    """
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    shards = max(8, -(-size // SHARD_BYTES))
    blocks = materialise(blocks_of(docs, shards), "blocks")
    requests = blocks.filter("shard >= 0").select("shard", "block", "keys", "counts")
    levels = united_requests(requests, blocks.filter("shard < 0").count())
    if levels:
        requests = levels[-1].select("shard", "block", "keys", "counts")
    state = materialise(requests.groupBy("shard").applyInArrow(_gather, _STATE), "shards")
    seen, totals = _summed(state, "seen"), _summed(state, "totals")
    if not len(seen):
        return docs.sparkSession.createDataFrame([], _RESULT)
    model = _model([int(v) for v in seen], totals)
    # One sample of the totals first, so that the samples that count start from settled ones.
    settled = Model(model.discounts, model.vocabulary,
                    Totals.of(sampled_totals(state, model)[-1]))
    exact = sampled_totals(state, settled)
    replies = answers(state, settled, exact)
    for united in reversed(levels):
        replies = handed_down(replies, united)
    texts = blocks.filter("shard < 0").select("block", "ids", "held", "sizes", "tokens")
    trained = int(seen[1])
    scored = texts.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        _score(trained, model.vocabulary),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, "
        "score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known",
                         F.lit(trained).cast("bigint").alias("train_tokens"),
                         "base_score", "score")


_RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, " \
          "train_tokens bigint, base_score double, score double"
