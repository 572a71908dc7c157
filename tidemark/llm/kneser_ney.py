"""Quality by the perplexity of an n-gram model trained on trusted text.

The model is an interpolated modified Kneser-Ney model of order 4 over the bytes of a text, with
a border before and after it. Counts of n-grams are summed per n-gram over the cluster; every
order's counts are joined with the sums of their contexts and give the discounted share of each
n-gram and the weight of each context.

Documents meet the counts in sharded joins. Texts are gathered into blocks of some megabytes, and
the distinct n-grams of each block are sent once to the shards of the model, which are cut by the
two middle bytes: these are shared by an n-gram of order 4, its context, its lower order and the
lower context, so one shard has all counts that its probability needs. What is left, order 2, has
65,536 n-grams at most, whatever the corpus, and goes along to every task. The answers return to
their block, and its documents sum them up. A shard answers `BLOCKS_TOGETHER` blocks in one group;
for more blocks it is dealt out again, so no group grows with the input, and an n-gram that is
frequent everywhere is asked for once a block.

Documents labelled good are trusted. The model learns, in each language, from at most `sample`
of them, those with the smallest hashes of their ids; a fifth of all never takes part, and of a
language without any in that fifth, none does. All trusted documents that the model did not
learn from judge: the quantile of their perplexities in a language, times `slack`, is the highest
perplexity that a document of that language may have. Where they are few, a quantile says little,
so it is drawn towards the language's median with the spread of all languages, by the weight of
`PRIOR_DOCUMENTS`. Quantiles come from counts of logarithms in steps of 1 / `STEPS`, rounded up.
Languages without trusted documents use the quantile over all languages. To be fair to short
texts, a perplexity is taken over the text and `PRIOR_TOKENS` tokens of the languages' mean.

Null and empty texts have one token, the end, and are judged like others. Repeated rows are
judged alike. An id that is labelled both good and bad is not trusted. Without trusted documents
all are kept. Other columns do not matter to `judged` and are kept by `kept_documents`. Empty
tables give empty results. A text must fit in one row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import join_small, row_keys, unpacked, utf8
from tidemark.session import materialise

ORDER = 4
SYMBOLS = 256
#: The byte before and after a text; UTF-8 has no such byte.
BORDER = b"\xff"
#: A constant of the code below: the middle bytes of an n-gram are spread over so many shards.
SHARDS = 64
BLOCK_BYTES = 4 << 20
#: So many blocks ask one copy of a shard.
BLOCKS_TOGETHER = 256
SAMPLE = 20_000
QUANTILE = 0.99
SLACK = 1.1
PRIOR_TOKENS = 200
PRIOR_DOCUMENTS = 100
HELD_OUT_OF = 5
STEPS = 20_000
#: Up to this many ids to learn from are broadcast, more are joined.
BROADCAST_IDS = 1_000_000
_PIECE = 1 << 20


def joined_texts(texts: Iterable[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts with their borders, one after another, and where each starts."""
    bordered = [BORDER * (ORDER - 1) + (t or b"") + BORDER for t in texts]
    sizes = np.fromiter(map(len, bordered), dtype=np.int64, count=len(bordered))
    return np.frombuffer(b"".join(bordered), dtype=np.uint8), np.cumsum(sizes) - sizes


def gram_pieces(symbols: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The place, the codes of the n-grams from there on, and which of them lie within a text."""
    for at in range(0, len(symbols) - ORDER + 1, _PIECE):
        part = symbols[at:at + _PIECE + ORDER - 1].astype(np.uint32)
        n = len(part) - ORDER + 1
        codes, inside = part[:n], np.ones(n, dtype=bool)
        for k in range(1, ORDER):
            codes = codes << np.uint32(8) | part[k:k + n]
            first, last = np.searchsorted(starts, [at + k, at + k + n])
            inside[starts[first:last] - k - at] = False
        yield at, codes, inside


#: Blocks are written once and shuffled once, so their texts are worth some compression.
_LEVEL = 6


def _compressed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=_LEVEL).compress(data)


def texts_of(block: pa.Scalar, sizes: pa.Scalar) -> Iterator[bytes]:
    """The texts of a block."""
    data, at = zstandard.ZstdDecompressor().decompress(block.as_py()), 0
    for size in sizes.as_py():
        yield data[at:at + size]
        at += size


def distinct_grams(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    found = [np.unique(codes[inside]) for _, codes, inside in gram_pieces(symbols, starts)]
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, codes, inside in gram_pieces(*joined_texts(utf8(batch.column(0)))):
            found, times = np.unique(codes[inside], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.astype(np.int64)), pa.array(times.astype(np.int64))],
                names=["code", "n"])


def gram_counts(docs: DataFrame) -> dict[int, DataFrame]:
    """Per order: `code`, `n`. Below the highest order, n counts the symbols seen before."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    counts = {ORDER: materialise(
        texts.mapInArrow(_count, "code bigint, n bigint").groupBy("code")
        .agg(F.sum("n").alias("n")), "gram_counts")}
    for order in range(ORDER - 1, 0, -1):
        counts[order] = counts[order + 1].groupBy(
            (F.col("code") % SYMBOLS ** order).alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return counts


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and more; 0.5, 1, 1.5 if undefined."""
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    wanted = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(wanted))


def model_tables(counts: dict[int, DataFrame]) -> list[tuple[DataFrame, DataFrame]]:
    """Per order from 1: shares (code, share) of the n-grams and weights (context, weight)."""
    tables = []
    for order in range(1, ORDER + 1):
        grams = counts[order]
        n = grams.agg(*(F.count_if(F.col("n") == k) for k in (1, 2, 3, 4))).first()
        low, middle, high = discounts(*n)
        discount = F.when(F.col("n") == 1, low).when(F.col("n") == 2, middle).otherwise(high)
        with_context = grams.select("code", "n", F.floor(F.col("code") / SYMBOLS)
                                    .cast("bigint").alias("context"), discount.alias("d"))
        contexts = with_context.groupBy("context").agg(
            F.sum("n").alias("total"), F.sum("d").alias("given"))
        shares = with_context.join(contexts, "context").select(
            "code", ((F.col("n") - F.col("d")) / F.col("total")).alias("share"))
        weights = contexts.select("context", (F.col("given") / F.col("total")).alias("weight"))
        tables.append((shares, weights))
    return tables


def collect_pairs(tables: list[tuple[DataFrame, DataFrame]]) -> np.ndarray:
    """The probability of every n-gram of order 2, from the tables of the orders up to it."""
    full = np.full(1, 1.0 / SYMBOLS)
    for order, (shares, weights) in enumerate(tables[:2], 1):
        share, weight = shares.toArrow(), weights.toArrow()
        given = np.ones(SYMBOLS ** (order - 1))
        given[weight.column(0).to_numpy()] = weight.column(1).to_numpy()
        # The lower order leaves out the first symbol, and has one value for all if it is the first.
        full = (given[:, None] * full[None, :] * np.ones((1, SYMBOLS))).reshape(-1)
        full[share.column(0).to_numpy()] += share.column(1).to_numpy()
    return full


def _shard_of(middle):
    """The shard of two middle bytes, as numbers of a column or an array."""
    spread = middle * 40503 % 65536
    return F.floor(spread / 1024).cast("int") if isinstance(middle, Column) else spread // 1024


def sharded_model(tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """`shard`, `kind`, `code`, `value`: shares and weights of order 4, then those of order 3."""
    code = F.col("code")
    middles = [F.floor(code / SYMBOLS) % SYMBOLS ** 2, code % SYMBOLS ** 2,
               F.floor(code / SYMBOLS), code]
    rows = None
    for kind, (table, middle) in enumerate(zip([*tables[3], *tables[2]], middles)):
        part = table.toDF("code", "value").select(
            _shard_of(middle).alias("shard"), F.lit(kind).alias("kind"), "code", "value")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def _in_blocks(names: list[str]) -> Callable:
    """Rows as rows of one block each: its texts as one, their sizes, arrays of other columns."""
    def finish(block: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        texts = [t or b"" for p in parts for t in utf8(p.column(0))]
        columns = [pa.array([len(t) for t in texts], pa.int64()), *(
            pa.concat_arrays([p.column(i) for p in parts]) for i in range(1, len(names) + 1))]
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([_compressed(b"".join(texts))], pa.binary()),
             *(pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns)],
            names=["block", "text", "sizes", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, parts, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(
                zero_copy_only=False)
            ends, at = np.cumsum(lengths.astype(np.int64) + ORDER), 0
            while at < batch.num_rows:
                before = int(ends[at - 1]) if at else 0
                upto = min(int(np.searchsorted(ends, before + BLOCK_BYTES - size)) + 1,
                           batch.num_rows)
                parts.append(batch.slice(at, upto - at))
                size += int(ends[upto - 1]) - before
                at = upto
                if size >= BLOCK_BYTES:
                    yield finish(block, parts)
                    block, parts, size = block + 1, [], 0
        if parts:
            yield finish(block, parts)

    return run


def packed_codes(codes: np.ndarray) -> bytes:
    """Sorted codes as their compressed differences."""
    return _compressed(np.diff(codes, prepend=np.uint32(0)).tobytes())


def unpacked_codes(data: bytes) -> np.ndarray:
    steps = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint32)
    return np.cumsum(steps, dtype=np.int64)


def _requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and shard: the distinct n-grams of the block's texts, sorted."""
    for batch in batches:
        for block, text, sizes in zip(*batch.columns):
            codes = distinct_grams(*joined_texts(texts_of(text, sizes)))
            shard = _shard_of(codes >> np.uint32(8) & np.uint32(0xFFFF))
            asked = [(k, codes[shard == k]) for k in np.unique(shard).tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block.as_py()] * len(asked), pa.int64()),
                 pa.array([k for k, _ in asked], pa.int32()),
                 pa.array([packed_codes(own) for _, own in asked], pa.binary())],
                names=["block", "shard", "codes"])


def _answers(pairs: np.ndarray) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(requests: pa.Table, model: pa.Table) -> pa.Table:
        kinds, codes, values = (model[c].to_numpy() for c in ("kind", "code", "value"))
        parts = []
        for kind in range(4):
            own = np.flatnonzero(kinds == kind)
            own = own[np.argsort(codes[own])]
            parts.append((codes[own], values[own]))

        def look(kind: int, wanted: np.ndarray, missing: float) -> np.ndarray:
            known, value = parts[kind]
            if not len(known):
                return np.full(len(wanted), missing)
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            return np.where(known[at] == wanted, value[at], missing)

        logs = []
        for data in requests["codes"]:
            gram = unpacked_codes(data.as_py())
            three = look(2, gram & 0xFFFFFF, 0.0) \
                + look(3, gram >> 8 & 0xFFFF, 1.0) * pairs[gram & 0xFFFF]
            four = look(0, gram, 0.0) + look(1, gram >> 8, 1.0) * three
            logs.append(np.log10(four).astype(np.float32).tobytes())
        return pa.Table.from_arrays(
            [requests["block"].cast(pa.int64()), requests["shard"].cast(pa.int32()),
             pa.array(logs, pa.binary())], names=["block", "shard", "logs"])

    return run


def _text_scores(names: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        symbols, starts = joined_texts(texts_of(block["text"][0], block["sizes"][0]))
        known = distinct_grams(symbols, starts)
        shard = _shard_of(known >> np.uint32(8) & np.uint32(0xFFFF))
        logs = np.zeros(len(known), dtype=np.float32)
        for k, data in zip(answers["shard"].to_pylist(), answers["logs"]):
            logs[shard == k] = np.frombuffer(data.as_py(), dtype=np.float32)
        scores = np.zeros(len(starts))
        for at, codes, inside in gram_pieces(symbols, starts):
            each = np.zeros(len(codes))
            each[inside] = logs[np.searchsorted(known, codes[inside])]
            first = np.searchsorted(starts, at, "right") - 1
            last = np.searchsorted(starts, at + len(codes))
            cuts = np.maximum(starts[first:last], at) - at
            scores[first:last] += np.add.reduceat(each, cuts)
        tokens = np.diff(np.r_[starts, len(symbols)]) - ORDER + 1
        return pa.Table.from_arrays(
            [*(block[c][0].values for c in names), pa.array(tokens), pa.array(scores)],
            names=[*names, "n_tokens", "score"])

    return run


def text_scores(texts: DataFrame, counts: dict[int, DataFrame]) -> DataFrame:
    """The columns of `texts` other than `text`, its `n_tokens` (bytes and the end) and `score`.

    The score is the log10 of the text's probability under the model of the n-gram counts.
    """
    rest = [f for f in texts.schema.fields if f.name != "text"]
    names = [f.name for f in rest]
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest)
    arrays = ", ".join(f"{f.name} array<{f.dataType.simpleString()}>" for f in rest)
    blocks = materialise(
        texts.select(F.col("text").cast("binary").alias("text"), *names).mapInArrow(
            _in_blocks(names), f"block bigint, text binary, sizes array<bigint>, {arrays}"),
        "text_blocks")
    copies = max(1, -(-blocks.count() // BLOCKS_TOGETHER))
    copy = F.pmod(F.xxhash64("block"), F.lit(copies)).alias("copy")
    requests = blocks.select("block", "text", "sizes").mapInArrow(
        _requests, "block bigint, shard int, codes binary").select("*", copy)
    tables = model_tables(counts)
    model = sharded_model(tables).withColumn(
        "copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(copies - 1).cast("bigint"))))
    answers = requests.groupBy("shard", "copy").cogroup(model.groupBy("shard", "copy")) \
        .applyInArrow(_answers(collect_pairs(tables)), "block bigint, shard int, logs binary")
    return materialise(
        blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
            _text_scores(names), f"{kept}, n_tokens bigint, score double"), "text_scores")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """`doc_id` of the documents labelled good and never bad."""
    return labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.min("quality").alias("quality")).filter("quality = 1 AND doc_id IS NOT NULL") \
        .select("doc_id")


def _held_out() -> Column:
    return F.pmod(F.xxhash64(F.lit("held out"), "doc_id"), F.lit(HELD_OUT_OF)) == 0


def _place() -> Column:
    """The upper 16 bits of an id's hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("trusted"), "doc_id"), 48)


def training_places(trusted: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """`lang` and `last`, the last place of the documents (`doc_id`, `lang`) to learn from.

    Up to it lie at most `sample` documents, or those of one place.
    """
    places = trusted.groupBy("lang", _place().alias("place")).agg(
        F.count_if(~_held_out()).alias("n"), F.count_if(_held_out()).alias("out"))
    # A window sees a row for each place: at most 2**16 of a language.
    up_to = F.sum("n").over(Window.partitionBy("lang").orderBy("place"))
    last = F.coalesce(F.max(F.when(F.col("up_to") <= sample, F.col("place"))),
                      F.min(F.when(F.col("n") > 0, F.col("place"))))
    return places.withColumn("up_to", up_to).groupBy("lang").agg(
        F.when(F.sum("out") > 0, last).otherwise(-1).alias("last"))


def _levels(counts: DataFrame, by: list[str], **shares: float) -> DataFrame:
    """Per group: the number of texts, and the first step that has each share up to it."""
    group = Window.partitionBy(*by or [F.lit(0)])
    up_to = counts.withColumn("up_to", F.sum("n").over(group.orderBy("step"))) \
        .withColumn("texts", F.sum("n").over(group))
    return up_to.groupBy(*by).agg(F.max("texts").alias("texts"), *(
        F.min(F.when(F.col("up_to") >= F.ceil(F.col("texts") * F.lit(share)), F.col("step")))
        .alias(name) for name, share in shares.items()))


def thresholds(texts: DataFrame, quantile: float) -> tuple[DataFrame, float | None]:
    """Per `lang`: `limit`, a perplexity's logarithm; and the limit over all languages.

    `texts` have `lang` and `log`, the logarithms of their perplexities.
    """
    counts = materialise(
        texts.groupBy("lang", F.ceil(F.col("log") * STEPS).alias("step"))
        .agg(F.count(F.lit(1)).alias("n")), "perplexity_counts")
    levels = materialise(_levels(counts, ["lang"], middle=0.5, own=quantile), "perplexity_levels")
    overall = _levels(counts.groupBy("step").agg(F.sum("n").alias("n")), [], own=quantile).first()
    if overall is None or overall["own"] is None:
        return levels.select("lang", F.lit(None).cast("double").alias("limit")), None
    spreads = join_small(counts, levels.select("lang", "middle"), "lang", levels.count()) \
        .groupBy((F.col("step") - F.col("middle")).alias("step")).agg(F.sum("n").alias("n"))
    spread = _levels(spreads, [], own=quantile).first()["own"]
    weight = F.col("texts") / (F.col("texts") + PRIOR_DOCUMENTS)
    limit = weight * F.col("own") + (1 - weight) * (F.col("middle") + spread)
    return levels.select("lang", (limit / STEPS).alias("limit")), overall["own"] / STEPS


def scored(texts: DataFrame, labels: DataFrame, sample: int = SAMPLE, quantile: float = QUANTILE,
           slack: float = SLACK) -> DataFrame:
    """n_tokens, score, perplexity, threshold and kept beside the columns of `texts` but `text`.

    `texts` has doc_id (bigint), lang and text (strings), and perhaps columns to tell rows apart.
    """
    trusted = materialise(trusted_ids(labels), "trusted_ids")
    in_docs = materialise(texts.select("doc_id", "lang").distinct().join(trusted, "doc_id"),
                          "trusted_languages")
    places = materialise(training_places(in_docs, sample), "training_places")
    languages = places.count()
    learnt = ~_held_out() & (_place() <= F.coalesce("last", F.lit(-1)))
    ids = materialise(join_small(in_docs, places, "lang", languages).filter(learnt)
                      .select("doc_id").distinct(), "training_ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    training = join_small(texts.select("doc_id", "lang", "text"), places, "lang", languages) \
        .filter(learnt).join(ids, "doc_id").select("text")
    scores = text_scores(texts, gram_counts(training))
    judged_by = materialise(
        join_small(scores, places, "lang", languages).filter(~learnt)
        .join(trusted, "doc_id").select("lang", "n_tokens", "score"), "trusted_scores")
    # The mean over everything that judges stands in for what a short text does not show.
    tokens, total = judged_by.agg(F.sum("n_tokens"), F.sum("score")).first()
    mean = total / tokens if tokens else 0.0
    # The logarithm of the perplexity.
    log = -(F.col("score") + PRIOR_TOKENS * mean) / (F.col("n_tokens") + PRIOR_TOKENS)
    by_language, overall = thresholds(judged_by.select("lang", log.alias("log")), quantile)
    by_language = materialise(by_language, "thresholds")
    threshold = F.pow(F.lit(10.0), F.coalesce("limit", F.lit(overall).cast("double"))) * slack
    return join_small(scores, by_language, "lang", by_language.count()).select(
        *scores.columns, F.pow(F.lit(10.0), log).alias("perplexity"),
        threshold.alias("threshold")).withColumn(
        "kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))


def _texts() -> list[Column]:
    return [F.col("doc_id").cast("bigint").alias("doc_id"),
            F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")]


def judged(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per row: `doc_id`, `lang`, `n_tokens`, `score`, `perplexity`, `threshold`, `kept`."""
    return scored(docs.select(*_texts()), labels, **options)


def kept_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that the classifier keeps."""
    keyed = row_keys(docs, "doc_id", "lang", "text")
    gone = scored(keyed.select("key", "key_rest", *_texts()), labels, **options) \
        .filter("NOT kept").select("key", "key_rest").distinct()
    return unpacked(keyed.select("row", "key", "key_rest").join(
        gone, ["key", "key_rest"], "left_anti").select("row"))
