"""Packing: documents cut into pieces, pieces put into windows of equal capacity.

A document is cut at every full window from its start, so only its rest has
to share windows; the rest is cut into pieces of at most a quarter window,
because differencing can only balance windows that hold several pieces. The
pieces are dealt by a hash to pools of bounded size. In each pool,
Karmarkar-Karp multiway differencing merges the two partial partitions with
the largest imbalance, largest sums against smallest, until one is left:
near-equal windows. If one exceeds the capacity, the number of windows rises.
"""

from __future__ import annotations

import functools
import heapq
import os
import struct
import unicodedata
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import stage


# Signs that are cut from the end of a word of letters.
SIGNS = ".,;:!?#*$%&|<>()\"-+/="


@dataclass(frozen=True)
class Settings:
    """``tokenizer``: a tokenizers file that every executor has; ``piece``: longest piece of a rest; ``pool``: pieces packed together, on average.

    ``remembered``: words, and parts of words, of which a worker remembers the
    ids, at about 125 bytes each. Fewer cost time, not results.
    """

    tokenizer: str
    capacity: int = 2048
    piece: int = 512
    end_id: int = 1
    pool: int = 1024
    remembered: int = 1_000_000


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of every item; sums are nearly equal.

    A partial partition is a row of sums in falling order, with a tree of items
    for each sum. Merging adds one partition's largest sums to the other's
    smallest. Ties are broken by the order of items.
    """
    n = len(sizes)
    left, right = np.full(2 * n + n * windows, -1, np.int64), np.full(2 * n + n * windows, -1, np.int64)
    nodes = n
    heap = []
    for i, size in enumerate(sizes.tolist()):
        sums, trees = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
        sums[0], trees[0] = size, i
        heap.append((-size, i, sums, trees))
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        _, _, sums, trees = heapq.heappop(heap)
        _, _, other_sums, other_trees = heapq.heappop(heap)
        sums, other_trees = sums + other_sums[::-1], other_trees[::-1]
        both = np.flatnonzero((trees >= 0) & (other_trees >= 0))
        joined = np.where(trees >= 0, trees, other_trees)
        fresh = np.arange(nodes, nodes + len(both))
        left[fresh], right[fresh], joined[both] = trees[both], other_trees[both], fresh
        nodes += len(both)
        order = np.argsort(-sums, kind="stable")
        sums, trees = sums[order], joined[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), made, sums, trees))
        made += 1
    window = np.zeros(n, np.int64)
    if n:
        for w, tree in enumerate(heap[0][3].tolist()):
            open_nodes = [tree] if tree >= 0 else []
            while open_nodes:
                node = open_nodes.pop()
                if node < n:
                    window[node] = w
                else:
                    open_nodes += (left[node], right[node])
    return window


def windows_of(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of every item, none above the capacity; items must not exceed it.

    The first try leaves two thousandths free, as sums are never quite equal.
    """
    windows = max(1, -(-int(sizes.sum()) * 1000 // (capacity * 998)))
    while True:
        window = differencing(sizes, windows)
        most = int(np.bincount(window, sizes, windows).max()) if len(sizes) else 0
        if most <= capacity:
            return window
        windows += max(1, windows * (most - capacity) // (2 * capacity))


def as_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds:
    """Token ids of texts, word by word; the ids of words seen before are remembered, within bounds.

    The tokenizer must drop white space and never join across it, split letters
    from the signs after them, and not tell A-Z from a-z, as a lower-case one
    with word ends does. A text's ids are then those of its words put together,
    and a word's those of its letters and of the signs that follow them. Ids are
    kept as bytes, so that no number becomes an object again.
    """

    def __init__(self, path: str, limit: int):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}

    def _split(self, word: str) -> tuple[str, str]:
        letters = word.rstrip(SIGNS)
        # A letter like U+0130 ends in a mark when it is lower-case, and the mark would join the signs.
        if not (letters.isascii() and letters.isalpha()) and not unicodedata.normalize("NFC", letters).lower().isalpha():
            return word, ""
        return letters.lower() if letters.isascii() else letters, word[len(letters) :]

    def _learn(self, words: set[str]) -> None:
        if len(self.words) + len(words) > self.limit:
            self.words.clear()
        if len(self.parts) > self.limit:
            self.parts = {"": b""}
        split = {w: self._split(w) for w in words}
        parts, tokenize = self.parts, self.tokenizer.model.tokenize
        other = []
        for part in {part for pair in split.values() for part in pair}.difference(parts):
            if part.isascii() and part.isalpha():  # lower-case letters reach the model as they are
                parts[part] = as_bytes([token.id for token in tokenize(part)])
            else:
                other.append(part)
        for part, found in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            parts[part] = as_bytes(found.ids)
        for word, (letters, signs) in split.items():
            self.words[word] = parts[letters] + parts[signs] if signs else parts[letters]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of several texts, of which the words fit in memory; little-endian unsigned 32-bit."""
        split = [text.replace("\n", " ").split(" ") for text in texts]
        words = set(chain.from_iterable(split))
        new = words.difference(self.words)
        if new:
            self._learn(new if len(self.words) + len(new) <= self.limit else words)
        get = self.words.__getitem__
        return [b"".join(map(get, own)) for own in split]


@functools.cache
def word_ids(path: str, limit: int) -> WordIds:
    """One memory of words for each worker process, kept from task to task."""
    return WordIds(path, limit)


def cuts(total: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    whole = total // capacity * capacity
    return [(s, capacity) for s in range(0, whole, capacity)] + [(s, min(piece, total - s)) for s in range(whole, total, piece)]


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def pieces(docs: DataFrame, use: Settings, with_ids: bool = True) -> DataFrame:
    """The pieces of every row of ``docs(doc_id, text, ...)``: each ends in ``end_id``, so a NULL or empty text has one piece.

    ``ids``: the piece's token ids, little-endian unsigned 32-bit; NULL unless asked for.
    """

    def run(batches):
        ids_of, end = word_ids(use.tokenizer, use.remembered), as_bytes([use.end_id])
        for batch in batches:
            for low in range(0, batch.num_rows, 100):
                part = batch.slice(low, 100)
                rows = []
                texts = [text or "" for text in part.column(1).to_pylist()]
                for doc_id, own_ids in zip(part.column(0).to_pylist(), ids_of(texts)):
                    ids = own_ids + end
                    total = len(ids) // 4
                    for start, length in cuts(total, use.capacity, use.piece):
                        own = ids[4 * start : 4 * (start + length)]
                        rows.append((doc_id, start, length, zlib.crc32(own), total, own if with_ids else None))
                kinds = [pa.int64()] * 5 + [pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECE)


def pack(docs: DataFrame, use: Settings, with_ids: bool = True) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; a sequence is filled without gaps and holds at most ``capacity`` ids.

    A full window is its own sequence (odd numbers); pools number theirs by
    pool and window (even numbers). Rows that repeat an id are packed each. No
    documents give no pieces.
    """
    cut = stage(pieces(docs, use, with_ids), "pieces").withColumn("_row", F.monotonically_increasing_id())
    full = cut.filter(F.col("length") == use.capacity).withColumns({"sequence_id": 2 * F.col("_row") + 1, "offset": F.lit(0).cast("long")})
    rests = cut.filter(F.col("length") < use.capacity)
    pools = max(1, -(-rests.count() // use.pool))
    capacity = use.capacity

    def run(pool: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_row", ignore_index=True)
        sizes = rows["length"].to_numpy()
        window = windows_of(sizes, capacity)
        order = np.argsort(window, kind="stable")
        ends = np.cumsum(sizes[order])
        begins = ends - sizes[order]
        first = np.searchsorted(window[order], np.unique(window))
        offset = np.empty(len(rows), np.int64)
        offset[order] = begins - np.repeat(begins[first], np.diff(np.append(first, len(rows))))
        return rows.assign(sequence_id=2 * (int(pool[0]) * 2**24 + window), offset=offset)[["_row", "sequence_id", "offset"]]

    placed = rests.select("_row", "length", F.pmod(F.xxhash64("_row"), F.lit(pools)).alias("pool")).groupBy("pool").applyInPandas(run, "_row long, sequence_id long, offset long")
    both = full.unionByName(rests.join(placed, "_row"))
    return both.drop("_row") if with_ids else both.drop("_row", "ids")
