"""Language-model scoring with a log-frequency Bloom filter.

n-gram counts are quantised on a log scale: a count c has level
1 + floor(log2(c)). The filter holds (n-gram, 1) to (n-gram, level); a count is
read back by asking for level after level until one is missing, so a false
positive can only overstate it. Bigram probabilities are smoothed towards
unigrams, and unigrams towards the uniform distribution.

The filter is cut into segments by n-gram hash; their number follows the
corpus, and each is counted and filled by one task into a written table. Workers
get a head of every segment by broadcast, with a fixed largest size in all: the
n-grams of the highest levels that fit. Where rarer ones do not fit, they are in
the segment's tail; texts then send the n-grams that the head does not know to
the tails, 4 bytes each, in one row for each slice of texts and segment, and get
their levels back. Every n-gram counts at every size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import WordHashes, crc_remainder, mix, stage
from granary.session import CLEANING, settings

SEGMENT_BITS = 1 << 21  # wanted; a power of two, like all sizes of filters here
# More segments than these only for tokens beyond so many in each: every slice of texts has a row for each segment.
MANY_SEGMENTS, SEGMENT_TOKENS = 1 << 10, 1 << 21
# Of text that is scored at once, but for a longer text; of n-grams looked up at once.
SLICE_BYTES, PROBED = 1 << 22, 1 << 18
# Rows that pass between Spark and a worker at once: some 4 MB of text.
BATCH_ROWS = "2000"
START = np.uint64(0x5A5A0001)
END = np.uint64(0x5A5A0002)


@dataclass(frozen=True)
class Settings:
    """``head_bits``: most bits of the filter that workers get; ``head``: words whose exact counts are broadcast.

    ``bits``: least bits for each entry, in heads and tails. ``prior``: weight
    of the unigram in a bigram's probability, in tokens. ``flush``: tokens whose
    n-grams a task adds up before it hands them over; ``slice``: texts scored at once.
    """

    folds: int = 5
    held: int = 1
    hashes: int = 3
    bits: int = 8
    head_bits: int = 1 << 29
    head: int = 1 << 18
    prior: float = 4.0
    flush: int = 1_000_000
    slice: int = 500


def tokens_of(texts: list[bytes | None], hashed: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, an end after each, in one array; and where each text starts."""
    own = [np.append(hashed((t or b"").lower().split()), END) for t in texts]
    return np.concatenate(own), np.cumsum([0] + [len(t) for t in own[:-1]])


def bigrams(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of every token with the one before it in its text."""
    before = np.roll(tokens, 1)
    before[starts] = START
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + tokens)


def levels_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log2(counts)).astype(np.int64)


def _two_power(least: int) -> int:
    return 1 << max(6, (int(least) - 1).bit_length())


def _places(grams: np.ndarray, level: int, size: int, hashes: int):
    """Bit numbers in a filter of ``size`` bits, for one hash function after the other; of the n-gram's hash, the low 32 bits count."""
    first = mix((grams & np.uint64(0xFFFFFFFF)) + np.multiply(np.uint64(level), np.array([0xD6E8FEB86659FD93], np.uint64)))
    second = (first >> np.uint64(32)) | np.uint64(1)
    for i in range(hashes):
        yield (first + np.uint64(i) * second) & np.uint64(size - 1)


def _filled(grams: np.ndarray, levels: np.ndarray, size: int, hashes: int) -> np.ndarray:
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for places in _places(grams[levels >= level], level, size, hashes):
            bits[places] = True
    return np.packbits(bits, bitorder="little")


def fill_segment(grams: np.ndarray, counts: np.ndarray, size: int, use: Settings) -> tuple[np.ndarray, np.ndarray | None]:
    """Head of ``size`` bits with all levels of the n-grams that reach the least level that fits; a tail with the others, None if there are none."""
    levels = levels_of(counts)
    for least in range(1, 65):
        chosen = levels >= least
        if int(levels[chosen].sum()) * use.bits <= size:
            break
    rest = ~chosen
    tail = _filled(grams[rest], levels[rest], _two_power(int(levels[rest].sum()) * use.bits), use.hashes) if rest.any() else None
    return _filled(grams[chosen], levels[chosen], size, use.hashes), tail


@dataclass
class Filter:
    """Equal parts of ``size`` bits, as many as ``parts``, one after the other."""

    filled: np.ndarray
    parts: int
    size: int
    hashes: int

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """The highest level found for every n-gram, 0 if none; asking stops at the first missing bit."""
        found = np.zeros(len(grams), np.uint8)
        alive = np.arange(len(grams))
        base = segment_of(grams, self.parts) * np.uint64(self.size)
        for level in range(1, 64):
            there = np.ones(len(alive), bool)
            for i, places in enumerate(_places(grams[alive], level, self.size, self.hashes)):
                asked = np.flatnonzero(there) if i else slice(None)
                bit = base[alive][asked] + places[asked]
                there[asked] = self.filled[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1
            alive = alive[there]
            if not len(alive):
                break
            found[alive] = level
        return found


def segment_of(grams: np.ndarray, segments: int) -> np.ndarray:
    return (grams >> np.uint64(32)) & np.uint64(segments - 1)


def segments_for(tokens: int, use: Settings) -> int:
    wanted = min(MANY_SEGMENTS, -(-2 * tokens * use.bits // SEGMENT_BITS))
    return 1 << (max(1, wanted, -(-tokens // SEGMENT_TOKENS)) - 1).bit_length()


def counts_at(levels: np.ndarray) -> np.ndarray:
    """The least count of every level, 0 for level 0."""
    return np.where(levels > 0, 2.0 ** (levels.astype(float) - 1), 0.0)


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, inverse = np.unique(keys, return_inverse=True)
    return unique, np.bincount(inverse, counts, len(unique)).astype(np.int64)


def _gathered(docs: DataFrame, make, use: Settings, emit, schema: str) -> DataFrame:
    """Counts of what ``make`` gives for each text, added up inside the task before they are emitted; memory is bounded by ``flush``."""

    def run(batches):
        hashed = WordHashes()
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                tokens, starts = tokens_of(batch.column(0).slice(low, 500).cast(pa.binary()).to_pylist(), hashed)
                held.append(make(tokens, starts))
                size += len(tokens)
                if size >= use.flush:
                    yield from emit(*np.unique(np.concatenate(held), return_counts=True))
                    held, size = [], 0
        if held:
            yield from emit(*np.unique(np.concatenate(held), return_counts=True))
        pa.default_memory_pool().release_unused()

    return docs.select("text").mapInArrow(run, schema)


def word_counts(docs: DataFrame, use: Settings) -> DataFrame:
    """``word`` (hash), ``c``: exact counts of all tokens, the end included."""

    def emit(keys, counts):
        for low in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(keys[low : low + 100_000].view(np.int64)), pa.array(counts[low : low + 100_000])], ["word", "c"])

    return _gathered(docs, lambda tokens, starts: tokens, use, emit, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _packed(keys: np.ndarray, counts: np.ndarray, segments: int) -> pa.RecordBatch:
    """A row for each segment: its n-grams (the high bits of the hash chose the segment, the low 32 tell them apart), and the counts above 1."""
    segment = segment_of(keys, segments)
    order = np.argsort(segment, kind="stable")
    found, cuts = np.unique(segment[order], return_index=True)
    rows = []
    for s, own in zip(found.tolist(), np.split(order, cuts[1:])):
        often = np.flatnonzero(counts[own] > 1)
        rows.append((s, keys[own].astype("<u4").tobytes(), often.astype("<u4").tobytes(), counts[own][often].astype("<i8").tobytes()))
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary(), pa.binary()))]
    return pa.RecordBatch.from_arrays(columns, ["segment", "grams", "often", "times"])


PACKED = "segment long, grams binary, often binary, times binary"


def fill_segments(docs: DataFrame, vocabulary: DataFrame, tokens: int, use: Settings) -> tuple[DataFrame, int, int]:
    """The written filter of all words of ``vocabulary(word, c)`` and all bigrams of ``docs(text)``, its segments, and the bits of a head.

    ``segment``, ``head``, ``tail`` (NULL if all fit into the head). The number of segments follows ``tokens``.
    """
    segments = segments_for(tokens, use)
    size = max(64, min(SEGMENT_BITS, 1 << (max(1, use.head_bits // segments).bit_length() - 1)))

    def pack_words(batches):
        held, size = [], 0
        for batch in batches:
            held.append((mix(batch.column(0).to_numpy().view(np.uint64)), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size >= use.flush:
                yield from emit(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if size:
            yield from emit(*map(np.concatenate, zip(*held)))

    def emit(keys, counts):
        if len(keys):
            yield _packed(keys, counts, segments)

    def fill(key: tuple, rows: pa.Table) -> pa.Table:
        grams, counts = [], []
        for g, often, times in zip(*(rows.column(c).to_pylist() for c in ("grams", "often", "times"))):
            grams.append(np.frombuffer(g, "<u4"))
            own = np.ones(len(grams[-1]), np.int64)
            own[np.frombuffer(often, "<u4")] = np.frombuffer(times, "<i8")
            counts.append(own)
        unique, summed = _sums(np.concatenate(grams), np.concatenate(counts))
        head, tail = fill_segment(unique.astype(np.uint64), summed, size, use)
        return pa.table([[key[0].as_py()], [head.tobytes()], pa.array([None if tail is None else tail.tobytes()], pa.binary())], ["segment", "head", "tail"])

    packed = vocabulary.select("word", "c").mapInArrow(pack_words, PACKED).unionByName(_gathered(docs, bigrams, use, emit, PACKED))
    return stage(packed.groupBy("segment").applyInArrow(fill, "segment long, head binary, tail binary"), "lm-segments"), segments, size


def _heads(filled: DataFrame, segments: int, size: int, use: Settings) -> Filter:
    """All heads in one piece: at most ``head_bits``, but for 8 bytes a segment."""
    bits = np.zeros((segments, size // 8), np.uint8)
    for row in filled.select("segment", "head").toLocalIterator():
        bits[row["segment"]] = np.frombuffer(row["head"], np.uint8)
    return Filter(bits.reshape(-1), segments, size, use.hashes)


def _frequent(vocabulary: DataFrame, most: int) -> DataFrame:
    """The words from the least eighth of a power of two up, by count, that at most ``most`` words reach; nothing is sorted."""
    level = F.floor(F.log2("c") * 8)
    least, reached = 1 << 30, 0
    for row in sorted(vocabulary.groupBy(level.alias("level")).count().collect(), reverse=True):  # at most 512 rows
        reached += row["count"]
        if reached > most:
            break
        least = row["level"]
    return vocabulary.filter(level >= least)


def log_probabilities(own: np.ndarray, pair: np.ndarray, starts: np.ndarray, ends: float, total: int, distinct: int, prior: float) -> np.ndarray:
    """log10 probability of each text under the smoothed bigram model, from the counts of its words and bigrams. A text starts as often as one ends."""
    before = np.roll(own, 1)
    before[starts] = ends
    uniform = (own + 0.5) / (total + 0.5 * (distinct + 1))
    return np.add.reduceat(np.log10((pair + prior * uniform) / (np.maximum(before, pair) + prior)), starts)


def _slices(batch: pa.RecordBatch, rows: int, size: int = SLICE_BYTES):
    """The batch in runs of at most ``rows`` texts and, but for a longer text, ``size`` bytes of the second column."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < batch.num_rows:
        fits = int(np.searchsorted(ends, (ends[low - 1] if low else 0) + size, "right"))
        high = max(low + 1, min(low + rows, fits))
        yield batch.slice(low, high - low)
        low = high


def _cut(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of bytes; ``offsets`` in bytes."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _uncut(rows: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of some rows in one array, and their offsets."""
    sizes = pc.binary_length(rows).to_numpy().astype(np.int64)
    return np.frombuffer(b"".join(rows.to_pylist()), np.uint8), np.append(0, np.cumsum(sizes))


# What goes to a segment: its tail, n-grams that a slice asks it for, and slices that wait for answers, in any segment.
TAIL, ASKED, WAITING = 0, 1, 2
MAIL = "segment long, slice long, kind int, data binary"
ROW = "doc_id long, held_out boolean, n_tokens long, known long, base double, score double, rest array<long>"


def _asked(grams: np.ndarray, number: int, segments: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """A row for each segment with the low 32 bits of its n-grams, in their order; and every n-gram's segment."""
    segment = segment_of(grams, segments).astype("<u4")
    order = np.argsort(segment, kind="stable")
    found, cuts = np.unique(segment[order], return_index=True)
    data = _cut(grams[order].astype("<u4"), 4 * np.append(cuts, len(grams)))
    rows = pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.repeat(pa.scalar(number, pa.int64()), len(found)), pa.repeat(pa.scalar(ASKED, pa.int32()), len(found)), data], ["segment", "slice", "kind", "data"])
    return rows, segment


def _waiting(texts: pa.RecordBatch, own: np.ndarray, pair: np.ndarray, segment: np.ndarray) -> bytes:
    """A slice with the levels that the head knows, 0 where it does not, and the segments asked for those, in one compressed piece."""
    nested = pa.ListArray.from_arrays(pa.array([0, texts.num_rows], pa.int32()), texts.to_struct_array())
    planes = segment.view(np.uint8).reshape(-1, 4).T.tobytes()  # the high bytes say little
    row = pa.RecordBatch.from_arrays([nested, *(pa.array([x], pa.binary()) for x in (own.tobytes(), pair.tobytes(), planes))], ["texts", "own", "pair", "segment"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(row)
    return sink.getvalue().to_pybytes()


def _answered(mail: DataFrame, use: Settings) -> DataFrame:
    """``slice``, ``segment``, ``data``: a byte for every n-gram asked, the level that the segment's tail knows; waiting slices as they came, with segment -1."""

    def probe(key: tuple, rows: pa.Table) -> pa.Table:
        kind = rows["kind"]
        asked, waiting = rows.filter(pc.equal(kind, ASKED)), rows.filter(pc.equal(kind, WAITING))
        bits = np.frombuffer(b"".join(rows["data"].filter(pc.equal(kind, TAIL)).to_pylist()), np.uint8)
        data, offsets = _uncut(asked["data"])
        grams = data.view("<u4")
        levels = np.zeros(len(grams), np.uint8)
        if len(bits):
            known = Filter(bits, 1, 8 * len(bits), use.hashes)
            for low in range(0, len(grams), PROBED):
                levels[low : low + PROBED] = known.levels(grams[low : low + PROBED].astype(np.uint64))
        columns = ["slice", "segment", "data"]
        answers = pa.Table.from_arrays([asked["slice"], asked["segment"], _cut(levels, offsets // 4)], columns)
        return pa.concat_tables([answers, pa.Table.from_arrays([waiting["slice"], pa.repeat(pa.scalar(-1, pa.int64()), len(waiting)), waiting["data"]], columns)])

    return mail.groupBy("segment").applyInArrow(probe, "slice long, segment long, data binary")


def score(docs: DataFrame, use: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs(doc_id, text, ...)``.

    NULL and empty texts have one token, the end. Rows whose id's crc32 modulo
    ``folds`` is ``held`` are not learnt from; rows with NULL id are. Without
    training rows nothing is known, and the counts are zero. ``base_score`` is
    exact: counts of the most frequent words are broadcast, the others joined.
    """
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS} | CLEANING):
        return _scored(docs, use)


def _scored(docs: DataFrame, use: Settings) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long"), "text").withColumn("held_out", crc_remainder(F.col("doc_id"), use.folds) == use.held)
    training = docs.filter(~F.col("held_out"))
    vocabulary = stage(word_counts(training, use), "lm-words")
    end = F.when(F.col("word") == int(END), F.col("c"))
    size = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(F.max(end), F.lit(0)).alias("ends")).first()
    total, distinct = size["n"], size["v"]
    ends = float(counts_at(levels_of(np.array([size["ends"]])))[0]) if size["ends"] else 0.0
    head = _frequent(vocabulary, use.head).toPandas()
    words, times = head["word"].to_numpy(np.int64).view(np.uint64), head["c"].to_numpy(np.int64)
    order = np.argsort(words)
    filled, segments, head_size = fill_segments(training, vocabulary, total, use)
    tails = filled.filter("tail IS NOT NULL").select("segment", F.lit(0).cast("long").alias("slice"), F.lit(TAIL).alias("kind"), F.col("tail").alias("data"))
    whole = tails.isEmpty()
    sent = docs.sparkSession.sparkContext.broadcast((_heads(filled, segments, head_size, use), words[order], times[order]))
    least = total + 0.5 * (distinct + 1)

    def scores_of(own: np.ndarray, pair: np.ndarray, starts: np.ndarray) -> pa.Array:
        return pa.array(log_probabilities(counts_at(own), counts_at(pair), starts, ends, total, distinct, use.prior))

    def run(batches):
        known_levels, words, times = sent.value
        hashed = WordHashes()
        number = 0 if whole else TaskContext.get().partitionId() << 33
        for part in (part for batch in batches for part in _slices(batch, use.slice)):
            tokens, starts = tokens_of(part.column(1).cast(pa.binary()).to_pylist(), hashed)
            at = np.minimum(np.searchsorted(words, tokens), max(0, len(words) - 1))
            there = words[at] == tokens if len(words) else np.zeros(len(tokens), bool)
            base, own = np.zeros(len(tokens)), np.zeros(len(tokens), np.uint8)
            base[there] = np.log10((times[at[there]] + 0.5) / least)
            own[there] = levels_of(times[at[there]])
            grams = np.concatenate([mix(tokens[~there]), bigrams(tokens, starts)])
            distinct_grams, places = np.unique(grams, return_inverse=True)
            levels = known_levels.levels(distinct_grams)[places]
            own[~there], pair = levels[: -len(tokens)], levels[-len(tokens) :]
            sizes = np.diff(np.append(starts, len(tokens)))
            known = np.add.reduceat(there.astype(np.int64), starts)
            offsets = np.append(0, np.cumsum(sizes - known)).astype(np.int32)
            tail = pa.ListArray.from_arrays(offsets, pa.array(tokens[~there].view(np.int64)))
            columns = {"doc_id": part.column(0), "held_out": part.column(2), "n_tokens": pa.array(sizes, pa.int64()), "known": pa.array(known, pa.int64()), "base": pa.array(np.add.reduceat(base, starts))}
            if whole:
                yield pa.RecordBatch.from_pydict(columns | {"score": scores_of(own, pair, starts), "rest": tail})
                continue
            asked, segment = _asked(grams[levels == 0], number, segments)
            yield asked
            data = _waiting(pa.RecordBatch.from_pydict(columns | {"rest": tail}), own, pair, segment)
            yield pa.RecordBatch.from_arrays([pa.array([mix(np.array([number], np.uint64))[0] % segments], pa.int64()), pa.array([number], pa.int64()), pa.array([WAITING], pa.int32()), pa.array([data], pa.binary())], ["segment", "slice", "kind", "data"])
            number += 1

    def finish(key: tuple, rows: pa.Table) -> pa.Table:
        data = rows.sort_by("segment")["data"]  # the slice itself, then the answers
        row = next(iter(pa.ipc.open_stream(data[0].as_buffer())))
        own, pair = (np.frombuffer(row[c][0].as_buffer(), np.uint8).copy() for c in ("own", "pair"))
        segment = np.ascontiguousarray(np.frombuffer(row["segment"][0].as_buffer(), np.uint8).reshape(4, -1).T).view("<u4")[:, 0]
        answers, _ = _uncut(data[1:])
        if len(answers) != len(segment):
            raise RuntimeError(f"{len(answers)} of {len(segment)} levels reached a slice")
        levels = np.empty(len(segment), np.uint8)
        levels[np.argsort(segment, kind="stable")] = answers
        rare = own == 0
        cut = int(rare.sum())
        own[rare], pair[pair == 0] = levels[:cut], levels[cut:]
        texts = pa.RecordBatch.from_struct_array(row["texts"].flatten())
        sizes = texts["n_tokens"].to_numpy()
        columns = dict(zip(texts.schema.names, texts.columns))
        rest = columns.pop("rest")
        return pa.table(columns | {"score": scores_of(own, pair, np.append(0, np.cumsum(sizes[:-1]))), "rest": rest})

    asked = docs.select("doc_id", "text", "held_out")
    if whole:
        scored = asked.mapInArrow(run, ROW)
    else:
        mail = asked.mapInArrow(run, MAIL).unionByName(tails)
        scored = _answered(mail, use).groupBy("slice").applyInArrow(finish, ROW)
    scored = stage(scored, "lm-scores").withColumn("_row", F.monotonically_increasing_id())
    sent.unpersist()
    rare = scored.select("_row", F.explode("rest").alias("word")).join(vocabulary, "word", "left").groupBy("_row").agg(
        F.count_if(F.col("c") > 0).alias("more"),
        F.sum(F.log10((F.coalesce("c", F.lit(0)) + 0.5) / F.lit(float(least)))).alias("added"),
    )
    return scored.drop("rest").join(rare, "_row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("added", F.lit(0.0))).alias("base_score"),
        "score",
    )
