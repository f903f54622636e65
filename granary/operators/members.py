"""Rows of a large table whose id is, or is not, among many ids, or has a value there, without moving the rows.

Ids that lie close together, as numbered ones do, fit into few words of 64 bits.
The words are counted when they are written; if they are few enough for every
worker to hold, they are broadcast, however many ids they stand for. If not,
the rows and the ids are joined as usual.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.sinks.lake import stage

# Words that every worker can hold: some 100 MB, 96 million ids without gaps.
MOST_WORDS = 1_500_000
# The same with a number for each id: some 110 MB, 12.8 million ids without gaps.
MOST_VALUED_WORDS = 200_000


def _word(value: Column) -> Column:
    return F.shiftright(value.cast("long"), 6)


def _place(value: Column) -> Column:
    return value.cast("long").bitwiseAND(63).cast("int")


@dataclass(frozen=True)
class Ids:
    """``frame``: one column of ids; ``words``: the same ids as ``_word`` and ``_mask``, None if these are too many. NULL is no id."""

    frame: DataFrame
    words: DataFrame | None

    @staticmethod
    def of(ids: DataFrame | Ids, most: int = MOST_WORDS) -> Ids:
        if isinstance(ids, Ids):
            return ids
        value = F.col(ids.columns[0])
        bit = F.expr("shiftleft(1L, _place)")
        placed = ids.filter(value.isNotNull()).select(_word(value).alias("_word"), _place(value).alias("_place"))
        words, written = stage(placed.groupBy("_word").agg(F.bit_or(bit).alias("_mask")), "packed-ids")
        return Ids(ids, words if written.rows <= most else None)

    def among(self, rows: DataFrame, key: str) -> DataFrame:
        """The rows whose ``key`` is one of the ids."""
        if self.words is None:
            return rows.join(self.frame.toDF(key), key, "left_semi").select(*rows.columns)
        return rows.join(F.broadcast(self.words), _word(F.col(key)) == F.col("_word")).filter(self._hit(key) == 1).select(*rows.columns)

    def without(self, rows: DataFrame, key: str) -> DataFrame:
        """The rows whose ``key`` is NULL or none of the ids."""
        if self.words is None:
            return rows.join(self.frame.toDF(key), key, "left_anti").select(*rows.columns)
        marked = rows.join(F.broadcast(self.words), _word(F.col(key)) == F.col("_word"), "left")
        return marked.filter(F.coalesce(self._hit(key), F.lit(0)) == 0).select(*rows.columns)

    @staticmethod
    def _hit(key: str) -> Column:
        return F.getbit(F.col("_mask"), _place(F.col(key))).cast("int")


@dataclass(frozen=True)
class Values:
    """``frame``: ids and a value of each; ``words``: the same packed, None if these are too many or an id comes twice."""

    frame: DataFrame
    words: DataFrame | None

    @staticmethod
    def of(pairs: DataFrame, most: int = MOST_VALUED_WORDS) -> Values:
        key, value = map(F.col, pairs.columns)
        placed = pairs.filter(key.isNotNull()).select(_word(key).alias("_word"), _place(key).alias("_place"), value.alias("_value"))
        packed = placed.groupBy("_word").agg(
            F.bit_or(F.expr("shiftleft(1L, _place)")).alias("_mask"), F.sort_array(F.collect_list(F.struct("_place", "_value"))).alias("_pairs")
        )
        packed = packed.select("_word", "_mask", F.col("_pairs._value").alias("_values"))
        twice = F.count_if(F.size("_values") != F.bit_count("_mask"))
        words, written = stage(packed, "packed-values", metrics={"twice": twice})
        return Values(pairs, words if written.rows <= most and not written.metrics.get("twice") else None)

    def joined(self, rows: DataFrame, key: str, name: str) -> DataFrame:
        """The rows whose ``key`` is one of the ids, once for each of its values, which is added as ``name``."""
        if self.words is None:
            return rows.join(self.frame.toDF(key, name), key).select(*rows.columns, name)
        met = rows.join(F.broadcast(self.words), _word(F.col(key)) == F.col("_word"))
        place = _place(F.col(key))
        # A word's values stand in the order of its bits.
        before = F.bit_count(F.col("_mask").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), place))))
        found = met.filter(F.getbit("_mask", place).cast("int") == 1)
        return found.select(*rows.columns, F.get("_values", before).alias(name))
