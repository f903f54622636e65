"""A Bloom filter made and asked with built-in functions; it travels with the plan."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS = 64


@dataclass(frozen=True)
class Bloom:
    """``words``: the filter's 64-bit words as text, which the optimizer folds into an array."""

    words: str
    bits: int
    seeds: tuple[int, ...]

    def holds(self, key: Column) -> Column:
        """False for sure for keys that were not put in, but for NULL keys, which give NULL or any answer."""
        array = F.split(F.lit(self.words), ",").cast("array<bigint>")
        answer = F.lit(True)
        for seed in self.seeds:
            bit = _bit(key, seed, self.bits)
            answer = answer & (F.getbit(F.get(array, _word(bit)), _place(bit)) == 1)
        return answer


def _bit(key: Column, seed: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits).cast("long"))


def _word(bit: Column) -> Column:
    return F.shiftright(bit, 6).cast("int")


def _place(bit: Column) -> Column:
    return (bit % WORD_BITS).cast("int")


def bits_for(count: int, error: float) -> int:
    """Bits for ``count`` keys at an error rate, in whole words."""
    bits = max(WORD_BITS, math.ceil(count * math.log(1 / error) / math.log(2) ** 2))
    return -(-bits // WORD_BITS) * WORD_BITS


def build(keys: DataFrame, count: int, bits: int, first_seed: int = 0) -> Bloom:
    """Filter of the only column of ``keys``; at most ``bits`` / 64 rows come to the driver."""
    hashes = max(1, min(40, round(bits / max(count, 1) * math.log(2))))
    seeds = tuple(first_seed + i for i in range(hashes))
    bit = F.explode(F.array(*[_bit(F.col(keys.columns[0]), s, bits) for s in seeds]))
    filled = keys.select(bit.alias("bit")).groupBy(_word(F.col("bit")).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("mask"))
    words = {row["word"]: row["mask"] for row in filled.collect()}
    return Bloom(",".join(str(words.get(i, 0)) for i in range(bits // WORD_BITS)), bits, seeds)
