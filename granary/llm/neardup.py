"""Near-duplicates by b-bit MinHash.

1. One pass over the texts: shingle hashes, set size, a 128-bit key of the set,
   512 minima, their band keys, and 2 mixed bits of every minimum, packed.
2. Documents with the same set form a class; its smallest id stands for it.
3. Representatives that share a band key meet in a bucket, whose smallest id is
   its hub. Each is compared with one hub, never all with all: the packed bits
   estimate the similarity, and what may reach the threshold is confirmed on
   full sets. Links join classes into components.
4. Who is not yet in the component of every hub it met is compared with another
   one. Buckets that then still hold several components are dealt into blocks,
   and every two blocks meet with full sets: pairs across components are
   estimated and confirmed in place, and only links that join components leave,
   so no link that changes a component is lost, and what leaves is no more than
   the documents.

A pair at similarity 0.8 shares one of 64 bands of 8 rows with probability
1 - (1 - 0.8**8)**64 > 0.99999; the estimate is allowed five standard errors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import WordHashes, mix, stage, window_hashes
from granary.llm.components import components

BITS = 2
BLOCK = 128
# Further comparisons with one hub each, before pairs across components.
MORE_STARS = 1
# Documents of a bucket in one block, on average.
MEMBERS = 256


@dataclass(frozen=True)
class Settings:
    """``percent``: least similarity, in hundredths; ``width``: words of a shingle."""

    width: int = 5
    percent: int = 80
    bands: int = 64
    rows: int = 8

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def least_estimate(self) -> float:
        chance = 0.5**BITS
        agree = chance + (1 - chance) * self.percent / 100
        error = (agree * (1 - agree) / self.hashes) ** 0.5 / (1 - chance)
        return self.percent / 100 - 5 * error


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    return np.unique(window_hashes(words, width))


def minima(sets: list[np.ndarray], hashes: int) -> np.ndarray:
    """The least value of every hash function over every set; blocks of shingles bound the memory."""
    draw = np.random.default_rng(20240501)
    flip = draw.integers(0, 1 << 32, hashes, dtype=np.uint32)
    factor = draw.integers(0, 1 << 31, hashes, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    out = np.full((len(sets), hashes), 0xFFFFFFFF, np.uint32)
    room = np.empty((BLOCK, hashes), np.uint32)
    for i, whole in enumerate(sets):
        short = (mix(whole) >> np.uint64(32)).astype(np.uint32)
        for start in range(0, len(short), BLOCK):
            part = short[start : start + BLOCK, None]
            values = room[: len(part)]
            np.bitwise_xor(part, flip, out=values)
            np.multiply(values, factor, out=values)
            np.minimum(out[i], values.min(axis=0), out=out[i])
    return out


def band_keys(least: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key for each band of minima; the band's number is part of it."""
    groups = least.reshape(len(least), bands, -1).astype(np.uint64)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), groups.shape[:2])
    for i in range(groups.shape[2]):
        keys = mix(keys + groups[:, :, i] + np.uint64(1))
    return keys


def packed_bits(least: np.ndarray) -> np.ndarray:
    """``BITS`` bits of every minimum, 32 to a 64-bit word.

    The low bits of a minimum depend on the low bits of its shingle alone, so
    two shingles would agree under all functions or none; the bits are taken
    after mixing the whole minimum with the number of its function.
    """
    number = np.arange(least.shape[1], dtype=np.uint64) << np.uint64(32)
    low = (mix(least.astype(np.uint64) | number) >> np.uint64(64 - BITS)).reshape(len(least), -1, 64 // BITS)
    return np.bitwise_or.reduce(low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)), axis=2)


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1).view(np.int64)))


def signatures(docs: DataFrame, use: Settings) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, bands, bits``; documents without words have size 0."""

    def run(batches):
        hashed = WordHashes()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            sets = [shingle_set(hashed((t or b"").lower().split()), use.width) for t in texts]
            least = minima(sets, use.hashes)
            spread = [mix(s + np.uint64(0x9E3779B97F4A7C15)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array([s.sum(dtype=np.uint64) for s in spread], np.uint64).view(np.int64)),
                    pa.array(np.array([np.bitwise_xor.reduce(mix(s)) if len(s) else 0 for s in spread], np.uint64).view(np.int64)),
                    _lists(band_keys(least, use.bands)),
                    _lists(packed_bits(least)),
                ],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands", "bits"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, bits array<long>")


def estimated(bits_a: Column, bits_b: Column, hashes: int) -> Column:
    """Similarity from packed bits, corrected for agreement by chance."""
    pairs = F.lit(0x5555555555555555)

    def differing(a, b):
        x = a.bitwiseXOR(b)
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(pairs))

    wrong = F.aggregate(F.zip_with(bits_a, bits_b, differing), F.lit(0), lambda total, n: total + n)
    chance = 0.5**BITS
    return (1 - wrong / hashes - chance) / (1 - chance)


def _full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    def run(batches):
        hashed = WordHashes()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            sets = [shingle_set(hashed((t or b"").lower().split()), width).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "members"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(ids, "id", "left_semi")
    return chosen.mapInArrow(run, "id long, members binary")


def _confirmed(pairs: DataFrame, docs: DataFrame, reps: DataFrame, use: Settings) -> DataFrame:
    """Of candidate ``pairs(u, v)``, those whose full sets reach the threshold."""
    known = reps.select("rep", "n_shingles", "bits")
    side = lambda name: known.select(F.col("rep").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"))
    likely = (
        pairs.join(side("u"), "u")
        .join(side("v"), "v")
        .filter(100 * F.least("n_u", "n_v") >= use.percent * F.greatest("n_u", "n_v"))
        .filter(estimated(F.col("bits_u"), F.col("bits_v"), use.hashes) >= use.least_estimate)
    )
    likely = stage(likely.select("u", "v").distinct(), "near-pairs")
    ids = stage(likely.select(F.col("u").alias("id")).union(likely.select("v")).distinct(), "near-ids")
    sets = stage(_full_sets(docs, ids, use.width), "near-sets")
    percent = use.percent

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    texts = (
        likely.join(sets.select(F.col("id").alias("v"), F.col("members").alias("b")), "v")
        .join(sets.select(F.col("id").alias("u"), F.col("members").alias("a")), "u")
        .select("u", "v", "a", "b")
    )
    return texts.mapInArrow(run, "u long, v long")


def _apart(buckets: DataFrame, links: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with their own, their hub's and the lowest component."""
    found = components(links)
    root = lambda name: found.select(F.col("vertex").alias(name), F.col("root").alias(f"{name}_root"))
    labelled = buckets.join(root("rep"), "rep", "left").withColumn("root", F.coalesce("rep_root", "rep"))
    mixed = labelled.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("bucket", "low")
    mixed = labelled.join(mixed, "bucket").join(root("hub"), "hub", "left")
    return mixed.select("bucket", "hub", "rep", "n_shingles", "root", "low", F.coalesce("hub_root", "hub").alias("hub_root"))


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima whose packed bits differ, for every row of ``a`` and of ``b``."""
    wrong = np.zeros((len(a), len(b)), np.int64)
    for i in range(a.shape[1]):
        x = a[:, i, None] ^ b[None, :, i]
        wrong += np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555))
    return wrong


def _links_between(left: pd.DataFrame, right: pd.DataFrame, use: Settings) -> list[tuple[int, int]]:
    """Links that join components, between the documents of two blocks of a bucket.

    Pairs are taken by falling estimate and confirmed on full sets; a pair whose
    components are joined already is passed over. A pair belongs to the first
    band that it shares.
    """
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.get(x, x) != x:
            x = above[x] = above.get(above[x], above[x])
        return x

    matrix = lambda frame, column: np.array(frame[column].tolist(), np.int64).reshape(len(frame), -1)
    band, chance = int(left["band"].iloc[0]), 0.5**BITS
    ids, sizes, roots = ([side[c].to_numpy() for side in (left, right)] for c in ("rep", "n_shingles", "root"))
    wrong = _differing(matrix(left, "bits").view(np.uint64), matrix(right, "bits").view(np.uint64))
    likely = (1 - wrong / use.hashes - chance) / (1 - chance) >= use.least_estimate
    likely &= roots[0][:, None] != roots[1][None, :]
    likely &= 100 * np.minimum(sizes[0][:, None], sizes[1][None, :]) >= use.percent * np.maximum(sizes[0][:, None], sizes[1][None, :])
    if left is right:
        likely = np.triu(likely)
    i, j = np.nonzero(likely)
    mine, theirs = matrix(left, "bands")[:, :band], matrix(right, "bands")[:, :band]
    parts = [slice(low, low + (1 << 15)) for low in range(0, len(i), 1 << 15)]
    first = [~(mine[i[p]] == theirs[j[p]]).any(1) for p in parts]
    first = np.concatenate(first) if first else np.zeros(0, bool)
    i, j = i[first], j[first]
    order = np.argsort(wrong[i, j], kind="stable")
    sets = [[np.frombuffer(x, np.uint64) for x in side["members"]] for side in (left, right)]
    found = []
    for a, b in zip(i[order].tolist(), j[order].tolist()):
        x, y = top(int(roots[0][a])), top(int(roots[1][b]))
        if x != y and _linked(sets[0][a], sets[1][b], use.percent):
            above[max(x, y)] = min(x, y)
            found.append((int(ids[0][a]), int(ids[1][b])))
    return found


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity."""
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _across(apart: DataFrame, docs: DataFrame, reps: DataFrame, use: Settings) -> DataFrame:
    """Links between components, of the buckets that hold several.

    A bucket is dealt into blocks of about ``MEMBERS`` documents, and each two
    blocks meet in one task with full sets; only links that join components
    leave it, fewer than it has documents.
    """
    apart = stage(apart.select("bucket", "rep", "root"), "near-apart")
    sizes = apart.groupBy("bucket").agg(F.ceil(F.count("*") / F.lit(MEMBERS)).cast("int").alias("blocks"))
    ids = stage(apart.select(F.col("rep").alias("id")).distinct(), "near-across-ids")
    sets = stage(_full_sets(docs, ids, use.width), "near-across-sets").withColumnRenamed("id", "rep")
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    meeting = F.transform(others, lambda o: F.struct(F.least(o, F.col("block")).alias("low"), F.greatest(o, F.col("block")).alias("high")))
    members = apart.join(sizes, "bucket").withColumn("block", block).select("bucket", "rep", "root", "block", F.explode(meeting).alias("meet"))
    known = reps.select("rep", "n_shingles", "bits", "bands").join(sets, "rep")
    rows = members.join(known, "rep").withColumn("band", F.array_position("bands", F.col("bucket")) - 1)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", ignore_index=True)
        left = rows[rows["block"] == rows["low"]]
        right = left if (rows["low"] == rows["high"]).all() else rows[rows["block"] == rows["high"]]
        found = _links_between(left, right, use) if len(left) and len(right) else []
        return pd.DataFrame(found, columns=["u", "v"]).astype("int64")

    grouped = rows.select("bucket", "meet.low", "meet.high", "block", "rep", "root", "n_shingles", "bits", "bands", "members", "band")
    return grouped.groupBy("bucket", "low", "high").applyInPandas(run, "u long, v long")


def near_duplicates(docs: DataFrame, use: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text, ...)``.

    Documents without words are linked with nothing and kept. Rows with NULL id
    take no part: no component, kept. Rows that repeat an id are one vertex.
    """
    signed = stage(signatures(docs, use), "near-signatures")
    taking = signed.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    reps = taking.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.min_by(F.struct("n_shingles", "bands", "bits"), "doc_id").alias("s"))
    reps = stage(reps.select("set_a", "set_b", "rep", "s.n_shingles", "s.bands", "s.bits"), "near-classes")

    met = reps.select("rep", "n_shingles", F.explode("bands").alias("bucket"))
    hubs = met.groupBy("bucket").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).filter("hub < last").select("bucket", "hub")
    buckets = stage(met.join(hubs, "bucket"), "near-buckets")
    star = buckets.filter("rep > hub").groupBy("rep").agg(F.min("hub").alias("u")).select("u", F.col("rep").alias("v"))
    links = stage(_confirmed(star, docs, reps, use), "near-links")
    for turn in range(MORE_STARS):
        apart = _apart(buckets, links)
        other = apart.filter("hub_root != root").groupBy("rep").agg(F.min_by("hub", F.xxhash64("hub", F.lit(turn))).alias("hub"))
        star = other.select(F.least("rep", "hub").alias("u"), F.greatest("rep", "hub").alias("v"))
        links = stage(links.union(_confirmed(star, docs, reps, use)), "near-links")

    more = _across(_apart(buckets, links), docs, reps, use)

    # An id whose rows have different sets ties their classes together.
    classes = reps.select("set_a", "set_b", "rep")
    member = taking.select("doc_id", "set_a", "set_b").join(classes, ["set_a", "set_b"])
    torn = member.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high").select("doc_id", "low")
    torn = member.join(torn, "doc_id").filter("rep > low").select(F.col("low").alias("u"), F.col("rep").alias("v"))
    final = components(links.union(more).union(torn))

    root = final.select(F.col("vertex").alias("rep"), "root")
    found = member.select("doc_id", "set_a", "set_b", "rep").distinct().join(root, "rep", "left")
    found = found.select("doc_id", "set_a", "set_b", F.coalesce("root", "rep").alias("component_id"))
    rows = signed.select("doc_id", "n_shingles", "set_a", "set_b").join(found, ["doc_id", "set_a", "set_b"], "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
