"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of neighbouring lines decides where chunks end,
so an insertion moves only the boundaries next to it. Stronger boundaries (more
zero bits) make longer chunks; the chunks of every strength are looked at, and
single lines that are long enough. Besides, the shortest chunk with enough words
is taken from every line with a word on and up to every such line, wherever
boundaries lie: the chunks inside a run of shared lines then cover the run (but
for blank lines at its ends), whatever surrounds it. A
chunk that the corpus has before, by the SHA-256 of its bytes and that of its
first occurrence, is cut out of the text.

Chunks overlap. A line goes only if an equal line at an earlier place is part of
the same chunk, so the first of equal lines always stays. Shortest chunks whose
copies overlap inside one text (lines that repeat themselves at once) are held
against other texts only.
"""

from __future__ import annotations

import collections
import hashlib
import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.llm.common import mix, stage


@dataclass(frozen=True)
class Settings:
    """``least_words``: of a chunk; ``levels``: strengths of boundaries; ``sieve_bits``: size of what workers get to skip unrepeated chunks."""

    least_words: int = 50
    levels: int = 3
    sieve_bits: int = 1 << 26


def line_hashes(lines: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, lines), np.uint64, len(lines))


def boundaries(hashes: np.ndarray) -> np.ndarray:
    """How strong the boundary after each line is: the zero bits at the end of a rolling hash over it and the line before."""
    before = np.concatenate([np.zeros(1, np.uint64), hashes[:-1]])
    rolled = mix(before * np.uint64(0x9E3779B97F4A7C15) + hashes)
    return np.bitwise_count((rolled & (~rolled + np.uint64(1))) - np.uint64(1))


def running_words(lines: list[bytes]) -> list[int]:
    """Words before every line, and of all lines."""
    return list(itertools.accumulate((len(x.split()) for x in lines), initial=0))


def anchored(lines: list[bytes], total: list[int], use: Settings) -> list[tuple[int, int]]:
    """Long lines, then the chunks of several lines between boundaries."""
    least, n = use.least_words, len(lines)
    found = dict.fromkeys((i, i + 1) for i in range(n) if total[i + 1] - total[i] >= least)
    strength = boundaries(line_hashes(lines)).tolist()
    ends = range(1, n)
    for level in range(1, use.levels + 1):
        ends = [b for b in ends if strength[b - 1] >= level]
        for a, b in itertools.pairwise([0, *ends, n]):
            if b - a > 1 and total[b] - total[a] >= least:
                found[a, b] = None
    return list(found)


def shortest(total: list[int], least: int) -> list[tuple[int, int]]:
    """(first line, one past the last), in order, of the shortest chunk with enough words from every line with a word on, and up to every such line."""
    n = len(total) - 1
    found = set()
    end = start = 0
    for i in range(n):
        if total[i + 1] == total[i]:
            continue
        while end <= n and total[end] < total[i] + least:
            end += 1
        if end <= n:
            found.add((i, end))
        if total[i + 1] >= least:
            while total[start + 1] <= total[i + 1] - least:
                start += 1
            found.add((start, i + 1))
    return sorted(found)


def _all_spans(lines: list[bytes], use: Settings) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chunks by boundaries and long lines; and the shortest ones that are not among them."""
    total = running_words(lines)
    if total[-1] < use.least_words:
        return [], []
    found = anchored(lines, total, use)
    known = set(found)
    return found, [x for x in shortest(total, use.least_words) if x not in known]


def spans(lines: list[bytes], use: Settings) -> list[tuple[int, int]]:
    """(first line, one past the last) of every chunk with enough words."""
    return [x for some in _all_spans(lines, use) for x in some]


@dataclass
class Chunks:
    """Of one text: hash, lines and bytes (from, to) of every chunk; and whether it is held against other texts only. Bodies stay in the text."""

    hashes: list[int]
    lines: list[tuple[int, int]]
    bytes: list[tuple[int, int]]
    others_only: list[bool]


def chunks_of(text: bytes, use: Settings) -> Chunks:
    """Texts have few lines, so plain lists take half the time that small arrays do."""
    lines = text.split(b"\n")
    found, sliding = _all_spans(lines, use)
    if not found and not sliding:
        return Chunks([], [], [], [])
    both = found + sliding
    starts = list(itertools.accumulate((len(x) + 1 for x in lines), initial=0))
    places = [(starts[a], starts[b] - 1) for a, b in both]
    view, digest = memoryview(text), xxhash.xxh64_intdigest
    hashes = [digest(view[a:b]) for a, b in places]
    # Equal chunks are equally many lines, so of those in order only neighbours need a look.
    ended, near = {}, set()
    for own, (first, last) in zip(hashes[len(found) :], sliding):
        if first < ended.get(own, 0):
            near.add(own)
        ended[own] = last
    return Chunks(hashes, both, places, [False] * len(found) + [own in near for own in hashes[len(found) :]])


def _texts(batch: pa.RecordBatch, column: int):
    return (text.as_buffer().to_pybytes() if text.is_valid else b"" for text in batch.column(column).cast(pa.binary()))


def _repeated(docs: DataFrame, use: Settings) -> DataFrame:
    """``chunk`` (hash) of all chunks that occur again. Each text gives a hash once, as 2 if the text alone repeats it."""

    def run(batches):
        chunks, times = [], []
        for batch in batches:
            for text in _texts(batch, 0):
                own = chunks_of(text, use)
                alone = collections.Counter(h for h, others_only in zip(own.hashes, own.others_only) if not others_only)
                for chunk in set(own.hashes):
                    chunks.append(chunk)
                    times.append(2 if alone[chunk] > 1 else 1)
                if len(chunks) >= 50_000:
                    yield batch_of(chunks, times)
                    chunks, times = [], []
        if chunks:
            yield batch_of(chunks, times)

    def batch_of(chunks, times):
        return pa.RecordBatch.from_arrays([pa.array(np.array(chunks, np.uint64).view(np.int64)), pa.array(times, pa.int64())], ["chunk", "n"])

    counted = docs.select("text").mapInArrow(run, "chunk long, n long")
    return counted.groupBy("chunk").agg(F.sum("n").alias("n")).filter("n > 1").select("chunk")


def _chunks(docs: DataFrame, use: Settings, sieve) -> DataFrame:
    """``chunk`` (hash), ``row_key``, ``doc_id``, ``first``, ``last``, ``others_only`` of the chunks that the sieve lets through, and the SHA-256 of their bytes as ``body``."""

    def run(batches):
        bits = memoryview(sieve.value).cast("Q")
        for batch in batches:
            rows = []
            for key, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _texts(batch, 2)):
                own = chunks_of(text, use)
                view = memoryview(text)
                for digest, (first, last), (a, b), others_only in zip(own.hashes, own.lines, own.bytes, own.others_only):
                    place = digest % use.sieve_bits
                    if not bits[place >> 6] >> (place & 63) & 1:
                        continue
                    rows.append((digest - (digest >> 63 << 64), key, doc_id, first, last, others_only, hashlib.sha256(view[a:b]).digest()))
                    if len(rows) == 50_000:
                        yield batch_of(rows)
                        rows = []
            yield batch_of(rows)

    def batch_of(rows):
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds)]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "row_key", "doc_id", "first", "last", "others_only", "body"])

    schema = "chunk long, row_key long, doc_id long, first int, last int, others_only boolean, body binary"
    return docs.select("_key", F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _sieve(repeated: DataFrame, use: Settings):
    """A bit for every repeated hash, at most ``sieve_bits`` / 64 rows at the driver, sent to the workers."""
    place = F.pmod(F.conv(F.hex("chunk"), 16, 10).cast("decimal(20,0)"), F.lit(use.sieve_bits)).cast("long")
    words = repeated.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("mask")).toPandas()
    bits = np.zeros(use.sieve_bits // 64, np.int64)
    bits[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64)
    return repeated.sparkSession.sparkContext.broadcast(bits.tobytes())


def dedup_lines(docs: DataFrame, use: Settings = Settings()) -> DataFrame:
    """``docs(doc_id, text, ...)`` with repeated chunks cut out of ``text``, and ``removed_lines`` (int).

    The first occurrence, by id (NULL last), text hash and place, stays. Rows
    that repeat both id and text are treated alike. NULL, empty and short texts
    stay as they are; a text of repeated chunks only becomes empty. A column
    ``removed_lines`` is replaced.
    """
    keyed = docs.drop("removed_lines").withColumn("_key", F.xxhash64("doc_id", "text"))
    repeated = stage(_repeated(keyed, use), "line-repeated")
    bodies = _chunks(keyed, use, _sieve(repeated, use)).join(repeated, "chunk", "left_semi")
    bodies = stage(bodies, "line-bodies")
    order = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)), "row_key", "first")
    origin = bodies.groupBy("chunk").agg(F.min(F.struct(order.alias("place"), "body")).alias("o"))
    later = bodies.join(origin, "chunk").filter((F.col("body") == F.col("o.body")) & (order > F.col("o.place")))
    later = later.filter(~F.col("others_only") | (F.col("row_key") != F.col("o.place.row_key")))
    cut = later.groupBy(F.col("row_key").alias("_key")).agg(F.collect_set(F.struct("first", "last")).alias("_cut"))

    def run(batches):
        at = position
        for batch in batches:
            texts, removed = [], []
            for text, cut_spans in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                gone = {i for s in cut_spans or () for i in range(s["first"], s["last"])}
                removed.append(len(gone))
                texts.append("\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone) if gone else text)
            columns = batch.columns[:-1]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.int32())], [*batch.schema.names[:-1], "removed_lines"])

    names = [c for c in docs.columns if c != "removed_lines"]
    position = names.index("text")
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField("removed_lines", T.IntegerType())])
    return keyed.join(cut, "_key", "left").select(*names, "_cut").mapInArrow(run, schema)
