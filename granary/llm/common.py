"""What several operators share: columns, words, hashing and staged tables."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary import session

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# A word is a run of anything but these: \x20 and \x09 to \x0D.
WORD = "[^\\x20\\x09-\\x0D]+"
# Words whose hash a worker remembers.
CACHED_WORDS = 400_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage(frame: DataFrame, purpose: str, partition_by: str | None = None) -> DataFrame:
    """The frame written to the shared scratch folder and read again: computed once, and safe if an executor is lost."""
    spark = frame.sparkSession
    path = session.scratch_path(spark, purpose)
    writer = frame.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(frame.schema).parquet(path).select(*frame.columns)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, even where ``use`` needs it inside a lambda.

    A plain column would be put into the lambda by the optimizer and computed
    again for every element.
    """
    return F.get(F.transform(F.array(value), use), 0)


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text, modulo; NULL ids give -1, so they are in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(-1))


def text_words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case. bytes.lower and bytes.split know ASCII only, which is the definition above."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHashes:
    """64-bit hashes of words, remembered for the frequent ones; memory is bounded."""

    def __init__(self, limit: int = CACHED_WORDS):
        self.limit, self.known = limit, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.limit:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for word in set(words).difference(known):
                known[word] = xxhash.xxh64_intdigest(word)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` words; of the whole sequence if it is shorter; none without words."""
    if not len(words):
        return words
    n = max(1, len(words) - width + 1)
    total = np.zeros(n, np.uint64)
    for i in range(min(width, len(words))):
        total = mix(total + words[i : i + n] + np.uint64(i + 1))
    return total


def ranked(frame: DataFrame, group: str, order: list[str], purpose: str) -> DataFrame:
    """The frame staged, with ``rank`` from 0 and the number of rows ``n`` within each value of ``group``.

    Rows are dealt out by range and sorted inside their partitions; only the
    row counts per partition and group are added up, so a group may hold any
    share of the rows. ``order`` should end in a column that tells equal rows
    apart if a third of them may be equal. An empty ``order`` numbers the rows
    as they lie, without a shuffle.
    """
    if order:
        frame = frame.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = stage(frame.withColumn("_at", F.monotonically_increasing_id()), purpose)
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    placed = placed.withColumns({"_part": part, "_at": place})
    runs = placed.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        group, "_part",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("n"),
    )
    numbered = placed.join(runs, [group, "_part"]).withColumn("rank", F.col("_at") + F.col("_shift"))
    return numbered.select(*frame.columns, "rank", "n")
