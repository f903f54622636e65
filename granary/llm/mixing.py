"""Mixing sources to target weights by Pfair scheduling.

Every source's documents stand in a fixed shuffled order and are cut into
blocks of equal size. With weight w, block i (from 0) is released at slot
floor(i / w) and due at slot ceil((i + 1) / w). In every slot the released
block with the earliest deadline goes first. After any number of slots a
source has had its weight's share of them, give or take less than one block.

The driver gives out slots until every source has been through once, one number
for each block; weights are then rounded to 1 / FINE only. A schedule of more
than ``most_slots`` repeats after so many, with weights rounded to their inverse,
which adds less than one block to the deviation each time. A given ``period``
does the same after ``period`` slots. Built-in functions only.
"""

from __future__ import annotations

import heapq
from array import array
from dataclasses import dataclass
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.llm.common import stage


# Shares of so many make up the weights.
FINE = 10**18
# Slots of a source in one row of the table that all workers get.
RUN = 64


@dataclass(frozen=True)
class Settings:
    """``block``: characters; ``power``: without given weights, a source weighs its characters to this power.

    ``period``: slots after which the schedule repeats, or None for as late as possible; ``most_slots``: bounds
    the table of slots, 8 bytes each, that all workers get.
    ``most_sources``: each source needs a weight, and the table of weights is sent to all workers.
    """

    block: int = 1 << 14
    period: int | None = None
    most_slots: int = 1 << 22
    power: float = 0.7
    bucket_rows: int = 10_000
    most_sources: int = 10_000


def whole_shares(weights: dict[str, float], period: int) -> dict[str, int]:
    """Slots of a period for every source, the largest remainders first, ties by name; one for each source that would get none."""
    rest = {s: Fraction(w) for s, w in weights.items()}
    shares: dict[str, int] = {}
    while True:
        total, free = sum(rest.values()), period - len(shares)
        exact = {s: w * free / total for s, w in rest.items()}
        low = [s for s, x in exact.items() if x < 1]
        if not low:
            break
        for s in low:
            shares[s] = 1
            del rest[s]
    found = {s: int(x) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (found[s] - exact[s], s))[: free - sum(found.values())]:
        found[s] += 1
    return {s: shares[s] if s in shares else found[s] for s in weights}


def pattern(shares: dict[str, int], end: int | None = None) -> dict[str, array]:
    """The slots of each source's blocks in one period, or before ``end`` in it, by earliest deadline among the released."""
    period = sum(shares.values())
    waiting = [(0, s, 0) for s in sorted(shares)]  # by release
    ready: list[tuple[int, str, int]] = []
    slots = {s: array("q") for s in shares}
    for slot in range(period if end is None else min(end, period)):
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * period // shares[s]), s, i))
        deadline, s, i = heapq.heappop(ready)
        assert slot < deadline
        slots[s].append(slot)
        if i + 1 < shares[s]:
            heapq.heappush(waiting, ((i + 1) * period // shares[s], s, i + 1))
    return slots


def schedule(weights: dict[str, float], blocks: dict[str, int], use: Settings) -> tuple[int, dict[str, array]]:
    """The period, and each source's slots in it, as far as they are needed for ``blocks``."""
    total = sum(map(Fraction, weights.values()))
    # The last block is due by then; one more slot, as FINE rounds.
    longest = max(-(-n * total // Fraction(weights[s])) for s, n in blocks.items()) + 1
    if use.period is not None:
        period = max(use.period, 2 * len(weights))
    else:
        period = FINE if longest <= use.most_slots else max(use.most_slots, 2 * len(weights))
    return period, pattern(whole_shares(weights, period), int(longest) if period == FINE else None)


def _granted(slots: array, period: int, end: int) -> int:
    """Blocks of a source in the slots before ``end``."""
    return end // period * len(slots) + sum(s < end % period for s in slots)


def _driver_table(spark: SparkSession, rows: list[tuple], columns: dict[str, pa.DataType]) -> DataFrame:
    found = list(zip(*rows)) if rows else [[]] * len(columns)
    return spark.createDataFrame(pa.table([pa.array(c, k) for c, k in zip(found, columns.values())], list(columns)))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, use: Settings = Settings()) -> DataFrame:
    """Adds ``pass``, ``block`` and ``slot`` to ``docs(doc_id, text, source, ...)``, one row each time a document is due.

    The schedule ends when every source has been through once, so no document
    is missing; a source that its weight calls for more often starts again.
    NULL sources count as the empty name. Sources without a given weight are an
    error. A document's size is its text's length, at least 1; it belongs to
    the block its first character falls in. Repeated rows are scheduled each.
    Columns of the added names are replaced; no rows give no rows.
    """
    docs = docs.drop("pass", "block", "slot", "_source", "_n", "_key", "_bucket", "_start", "_share", "_number", "_run")
    keyed = docs.withColumns(
        {
            "_source": F.coalesce(F.col("source").cast("string"), F.lit("")),
            "_n": F.greatest(F.coalesce(F.length("text"), F.lit(0)), F.lit(1)).cast("long"),
            "_key": F.md5(F.concat_ws(" ", F.col("doc_id").cast("string"), F.xxhash64("text").cast("string"))),
        }
    )
    sizes = keyed.groupBy("_source").agg(F.sum("_n").alias("n"), F.count("*").alias("rows")).limit(use.most_sources + 1).collect()
    if len(sizes) > use.most_sources:
        raise ValueError(f"more than {use.most_sources} sources: group them before mixing")
    given = {r["_source"]: r["n"] ** use.power if weights is None else weights[r["_source"]] for r in sizes}
    blocks = {r["_source"]: -(-r["n"] // use.block) for r in sizes}
    period, slots = schedule(given, blocks, use) if given else (1, {})
    last = {s: (n - 1) // len(slots[s]) * period + slots[s][(n - 1) % len(slots[s])] for s, n in blocks.items()}
    end = max(last.values(), default=-1) + 1
    plan, runs = [], []
    for s, n in blocks.items():
        plan.append((s, n, len(slots[s]), _granted(slots[s], period, end)))
        runs.extend((s, k // RUN, slots[s][k : k + RUN].tolist()) for k in range(0, len(slots[s]), RUN))
    plan = _driver_table(docs.sparkSession, plan, {"_source": pa.string(), "blocks": pa.int64(), "_share": pa.int64(), "granted": pa.int64()})
    runs = _driver_table(docs.sparkSession, runs, {"_source": pa.string(), "_run": pa.int64(), "slots": pa.list_(pa.int64())})

    # Running sizes in two steps, so that no task holds a whole source.
    digits = 1
    while sum(r["rows"] for r in sizes) > use.bucket_rows * 16**digits:
        digits += 1
    keyed = keyed.withColumn("_bucket", F.substring("_key", 1, digits))
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keyed.groupBy("_source", "_bucket").agg(F.sum("_n").alias("n")).select("_source", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_source", "_bucket").orderBy("_key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.join(stage(offsets, "mix-offsets"), ["_source", "_bucket"]).withColumn("_start", F.col("_offset") + F.coalesce(F.sum("_n").over(within), F.lit(0)))
    placed = placed.withColumn("block", F.floor(F.col("_start") / F.lit(use.block)).cast("long")).join(F.broadcast(plan), "_source")
    placed = placed.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(granted - 1 - block) div blocks"))))
    placed = placed.withColumn("_number", F.col("pass") * F.col("blocks") + F.col("block"))
    placed = placed.withColumn("_run", F.expr(f"_number % _share div {RUN}")).join(F.broadcast(runs), ["_source", "_run"])
    slot = F.expr(f"_number div _share * {period}L + get(slots, cast(_number % _share % {RUN} AS int))")
    return placed.withColumn("slot", slot).select(*docs.columns, "pass", "block", "slot", "_start")


def in_order(mixed: DataFrame) -> DataFrame:
    """The rows in the order of the schedule, over as many files as the cluster writes; helper columns go."""
    return mixed.repartitionByRange("slot", "_start").sortWithinPartitions("slot", "_start").drop("pass", "block", "slot", "_start")
