"""Exact quantiles of groups of any size, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.sinks.lake import stage

# Rank error of the sketch is at most rows / SKETCH_ACCURACY.
SKETCH_ACCURACY = 10_000
# A bracket is narrowed until it holds no more distinct values than this.
BRACKET_VALUES = 100_000
# Cells that one narrowing cuts a bracket into.
CELLS = 64


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    bracket_values: int = BRACKET_VALUES,
) -> DataFrame:
    """Per group one row with ``quantis``: the interpolated quantiles, in order.

    Spark's exact percentile keeps all distinct values of a group in one task.
    Here a mergeable sketch brackets each wanted rank; a second pass counts the
    rows below each bracket and the distinct values inside it, both combined in
    the map tasks. Brackets are cut into cells, of which only those around the
    rank stay, until the distinct values that are ranked are few. All groups
    take this path, whatever their size; rows whose key is NULL are a group. A
    rank that the counts do not contain is an error, never a NULL.
    """
    keys = list(keys) or ["_all"]
    data = df.withColumn("_all", F.lit(0)) if keys == ["_all"] else df
    data = data.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    brackets, _ = stage(_brackets(data, keys, probabilities), "quantile-brackets")
    placed = _same(data, brackets, keys)
    numbers = range(len(probabilities))
    below = placed.groupBy(*keys).agg(*[F.count_if(F.col("_v") < F.col("_lows")[i]).alias(f"_{i}") for i in numbers])
    below = below.select(*keys, F.posexplode(F.array(*[F.col(f"_{i}") for i in numbers])).alias("_number", "_below"))
    holding = F.filter(F.sequence(F.lit(0), F.lit(len(probabilities) - 1)), lambda i: (F.col("_v") >= F.col("_lows")[i]) & (F.col("_v") <= F.col("_highs")[i]))
    inside = placed.select(*keys, "_v", F.explode(holding).alias("_number")).groupBy(*keys, "_number", "_v").agg(F.count("*").alias("_n"))
    wanted = brackets.select(*keys, F.posexplode("_positions").alias("_number", "_position"))
    part = [*keys, "_number"]
    ranks, _ = stage(_same(wanted, below, part), "quantile-ranks")
    counted, _ = stage(inside, "quantile-values")
    while (widest := _widest(counted, part)) > bracket_values:
        counted, ranks = _narrowed(counted, ranks, part)
        if _widest(counted, part) >= widest:
            break

    ordered = Window.partitionBy(*part).orderBy("_v")
    ranked = _same(counted, ranks, part).withColumn("_upto", F.col("_below") + F.sum("_n").over(ordered))
    first, last = F.col("_upto") - F.col("_n"), F.col("_upto") - 1

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank <= last), F.col("_v")))

    lower = F.floor("_position")
    found = ranked.groupBy(*part).agg(at(lower).alias("_lo"), at(F.ceil("_position")).alias("_hi"), F.max(F.col("_position") - lower).alias("_part"))
    missed = F.raise_error(F.lit("a quantile's rank lies outside its bracket")).cast("double")
    result = F.when(F.col("_lo").isNull() | F.col("_hi").isNull(), missed).otherwise(F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part"))
    pairs = F.sort_array(F.collect_list(F.struct("_number", result.alias("q"))))
    return found.groupBy(*keys).agg(F.transform(pairs, lambda p: p["q"]).alias("quantis")).drop("_all")


def _brackets(data: DataFrame, keys: list[str], probabilities: Sequence[float]) -> DataFrame:
    """Per group: the zero-based position of each quantile, and values on both sides of it."""
    margin = 4.0 / SKETCH_ACCURACY
    edges = [max(p - margin, 0.0) for p in probabilities] + [min(p + margin, 1.0) for p in probabilities]
    sketch = data.groupBy(*keys).agg(
        F.count("*").alias("_rows"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", edges, SKETCH_ACCURACY).alias("_edges"),
    )
    half = len(probabilities)
    # One rank more on each side, because interpolation needs the neighbours of groups too small for the margin.
    few = F.col("_rows") * margin < 2
    low = [F.when(few | F.lit(edges[i] == 0.0), F.col("_min")).otherwise(F.col("_edges")[i]) for i in range(half)]
    high = [F.when(few | F.lit(edges[half + i] == 1.0), F.col("_max")).otherwise(F.col("_edges")[half + i]) for i in range(half)]
    position = [F.lit(float(p)) * (F.col("_rows") - 1) for p in probabilities]
    return sketch.select(*keys, F.array(*position).alias("_positions"), F.array(*low).alias("_lows"), F.array(*high).alias("_highs"))


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys of which NULL equals NULL."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    equal = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(other, equal).drop(*[f"_right_{k}" for k in keys])


def _widest(counted: DataFrame, part: list[str]) -> int:
    return counted.groupBy(*part).count().agg(F.max("count")).first()[0] or 0


def _narrowed(counted: DataFrame, ranks: DataFrame, part: list[str]) -> tuple[DataFrame, DataFrame]:
    """Of every bracket the cells that hold the ranks next to its position, and the rows below them."""
    steps = [i / CELLS for i in range(1, CELLS)]
    edges = counted.groupBy(*part).agg(F.percentile_approx("_v", steps, SKETCH_ACCURACY).alias("_edges"))
    celled = _same(counted, edges, part).withColumn("_cell", F.size(F.filter("_edges", lambda e: e < F.col("_v")))).drop("_edges")
    celled, _ = stage(celled, "quantile-cells")
    cells = _same(celled.groupBy(*part, "_cell").agg(F.sum("_n").alias("_rows")), ranks, part)
    upto = F.sum("_rows").over(Window.partitionBy(*part).orderBy("_cell"))
    cells = cells.withColumn("_end", F.col("_below") + upto).withColumn("_begin", F.col("_end") - F.col("_rows"))
    chosen = cells.filter((F.col("_begin") <= F.ceil("_position")) & (F.col("_end") > F.floor("_position")))
    chosen, _ = stage(chosen.select(*part, "_cell", "_begin", "_position"), "quantile-chosen")
    kept, _ = stage(_same(celled, chosen.select(*part, "_cell"), [*part, "_cell"]).drop("_cell"), "quantile-values")
    return kept, chosen.groupBy(*part).agg(F.max("_position").alias("_position"), F.min("_begin").alias("_below"))
