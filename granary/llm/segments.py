"""Exact top-k search by inner product with segment statistics on several resolutions.

A vector is cut into segments, and each segment is described by its mean and
its deviation (the length of what is left without the mean). For two vectors
the product of a segment is at most ``length * mean * mean + deviation *
deviation``, so the sum over segments is an upper bound of the inner product:
with ``|q - x|^2 = |q|^2 + |x|^2 - 2 q.x``, a lower bound of their distance. The
description of a resolution is itself a vector of twice as many numbers as
segments, and the bound is an inner product of two descriptions. Pairs are
tested coarse to fine, 2, 4, 8, ... segments; those that stay are computed
exactly.

A bound decides nothing without a score to beat. Rows are dealt by hash into
shells, each sixteen times the one before, the first about 4,096 rows. After
each shell every query knows its best so far, and the next shell needs to hand
over only what is better: about eighty rows a query and shell, whatever the size
of the table. Queries travel to the rows in groups of bounded size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import stage

LIMIT = 1 << 63
# Whole numbers below this are exact as doubles; scores are cut off at the other.
EXACT, MOST = 2.0**53, 10**38
FOUND = "class_id long, vec_id long, own long, score decimal(38,0)"


@dataclass(frozen=True)
class Settings:
    """``scale``: components are floor(scale * c); ``group_bytes``: most bytes of queries that travel at once; ``rows``, ``queries``: compared at once."""

    k: int = 5
    scale: int = 256
    first_shell: int = 4096
    growth: int = 16
    group_bytes: int = 16 << 20
    rows: int = 2048
    queries: int = 256


def resolutions(size: int) -> list[int]:
    """Numbers of segments, coarse to fine, whose description is shorter than the vector."""
    return [2**i for i in range(1, size.bit_length()) if 2 ** (i + 1) < size]


def description(x: np.ndarray, segments: int) -> np.ndarray:
    """Per row: root of length times mean, and deviation, of each segment."""
    edges = np.linspace(0, x.shape[1], segments + 1).astype(int)
    length = np.diff(edges)
    mean = np.add.reduceat(x, edges[:-1], 1) / length
    rest = x - np.repeat(mean, length, 1)
    return np.concatenate([mean * np.sqrt(length), np.sqrt(np.add.reduceat(rest**2, edges[:-1], 1))], 1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers: in doubles where they cannot round, else in Python's integers."""
    if not len(a) or np.abs(a).max() * np.abs(b).max() * a.shape[1] < EXACT:
        return np.einsum("ij,ij->i", a, b)
    whole = np.vectorize(int, otypes=[object])
    return np.clip((whole(a) * whole(b)).sum(1), 1 - MOST, MOST - 1)


def just_below(score: np.ndarray) -> np.ndarray:
    """Doubles that are equal to scores where doubles are exact, and less elsewhere."""
    near = score.astype(float)
    return np.where(np.abs(near) < EXACT, near, np.nextafter(near, -np.inf))


class Ranks:
    """The best of each query so far: ``k`` rows by falling score, then vec_id; rows equal in id and vector count once."""

    def __init__(self, queries: int, k: int, floor: np.ndarray, floor_id: np.ndarray):
        self.k, self.floor, self.floor_id = k, floor.copy(), floor_id.copy()
        self.query, self.score, self.ids, self.own = (np.empty(0, t) for t in (np.int64, object, np.int64, np.int64))

    def beats(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        floor = self.floor[query]
        return (score > floor) | ((score == floor) & (ids <= self.floor_id[query]))

    def add(self, query, score, ids, own) -> None:
        query, score = np.append(self.query, query), np.append(self.score, score.astype(object))
        ids, own = np.append(self.ids, ids), np.append(self.own, own)
        order = np.lexsort((own, ids, -score, query))
        query, score, ids, own = query[order], score[order], ids[order], own[order]
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1]) | (own[1:] != own[:-1])
        query, score, ids, own = query[new], score[new], ids[new], own[new]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        last, kept = place == self.k - 1, place < self.k
        self.floor[query[last]], self.floor_id[query[last]] = just_below(score[last]), ids[last]
        self.query, self.score, self.ids, self.own = query[kept], score[kept], ids[kept], own[kept]


class Matcher:
    """Queries of one length against blocks of rows of that length."""

    def __init__(self, q: np.ndarray, floor: np.ndarray, floor_id: np.ndarray, use: Settings, k: int):
        self.q, self.use, self.ranks = q, use, Ranks(len(q), k, floor, floor_id)
        self.described = [description(q, s) for s in resolutions(q.shape[1])]
        self.norm = np.linalg.norm(q, axis=1)

    def take(self, x: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        described = [description(x, s) for s in resolutions(x.shape[1])]
        norm = np.linalg.norm(x, axis=1)
        for low in range(0, len(self.q), self.use.queries):
            part = slice(low, low + self.use.queries)
            self._slab(part, x, norm, described, ids, own)

    def _slab(self, part: slice, x, norm, described, ids, own) -> None:
        # Room for rounding, so that a bound stays one. Numbers too big for doubles exclude nothing.
        needed = self.ranks.floor[part][:, None] - 1e-9 * self.norm[part][:, None] * norm[None, :]
        alive = np.ones(needed.shape, bool)
        pairs = None
        for mine, theirs in zip(self.described, described):
            if pairs is None:
                alive &= ~(mine[part] @ theirs.T < needed)
                if alive.mean() < 0.1:
                    pairs = np.nonzero(alive)
            else:
                i, j = pairs
                fits = ~(np.einsum("ij,ij->i", mine[part][i], theirs[j]) < needed[i, j])
                pairs = i[fits], j[fits]
        if pairs is None:
            # Most pairs are left: one product of doubles finds those worth an exact look.
            alive &= ~(self.q[part] @ x.T < needed)
            pairs = np.nonzero(alive)
        i, j = pairs
        for low in range(0, len(i), 1 << 16):
            a, b = i[low : low + (1 << 16)], j[low : low + (1 << 16)]
            score = products(self.q[part][a], x[b])
            better = self.ranks.beats(a + part.start, score, ids[b])
            self.ranks.add(a[better] + part.start, score[better], ids[b][better], own[b][better])


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows; floor turns the scaled components into whole numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _by_length(batch):
    """The parts of a batch whose vectors are equally long."""
    sizes = pc.list_value_length(batch.column("x")).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        yield int(size), batch.filter(pa.array(sizes == size))


def _usable(vectors: DataFrame, use: Settings) -> DataFrame:
    """``vec_id, x, own``: vectors that take part, as whole numbers kept in doubles, and a hash that tells rows of one id apart."""
    scaled = F.transform("embedding", lambda c: F.lit(float(use.scale)) * c.cast("double"))
    fine = F.forall("s", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & (F.size("s") > 0)
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("s")).filter("vec_id IS NOT NULL").filter(F.coalesce(fine, F.lit(False)))
    # Adding zero turns -0.0 into 0.0; beyond 2^53 every double is whole.
    whole = F.transform("s", lambda c: F.when(F.abs(c) < 2.0**53, F.floor(c).cast("double") + 0.0).otherwise(c))
    return kept.select("vec_id", whole.alias("x")).withColumn("own", F.xxhash64("x"))


def _search(rows: DataFrame, group: pa.Table, use: Settings) -> DataFrame:
    """The best rows of each task for the queries of ``group(class_id, x, floor, floor_id)``, as far as they beat the floors."""
    k = use.k + 1
    shared = rows.sparkSession.sparkContext.broadcast(group)

    def run(batches):
        matchers, classes = {}, {}
        for size, part in _by_length(shared.value.combine_chunks().to_batches()[0]):
            classes[size] = part.column("class_id").to_numpy()
            floor = part.column("floor").to_numpy(zero_copy_only=False)
            matchers[size] = Matcher(_matrix(part.column("x")), floor, part.column("floor_id").to_numpy(), use, k)
        for batch in batches:
            for size, part in _by_length(batch):
                if size in matchers:
                    for low in range(0, part.num_rows, use.rows):
                        block = part.slice(low, use.rows)
                        matchers[size].take(_matrix(block.column("x")), block.column("vec_id").to_numpy(), block.column("own").to_numpy())
        for size, matcher in matchers.items():
            best = matcher.ranks
            scores = pa.array([int(s) for s in best.score], pa.decimal128(38, 0)) if len(best.score) else pa.array([], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(classes[size][best.query]), pa.array(best.ids), pa.array(best.own), scores], ["class_id", "vec_id", "own", "score"])

    return rows.select("vec_id", "own", "x").mapInArrow(run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("class_id").orderBy(F.desc("score"), "vec_id", "own")
    return found.distinct().withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def top_products(vectors: DataFrame, every: int = 50, use: Settings = Settings()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the largest integer inner product for every row whose id is divisible by ``every``.

    ``vectors(vec_id, embedding, ...)``; a component becomes floor(scale * c). A
    row is an id and a vector: rows that repeat both count once, an id with
    several vectors is several rows and queries, and a query leaves out only the
    row that it is. Ties go to the smaller id. Vectors that are NULL or empty,
    hold NULL or components that are not finite when scaled, and rows without
    id take no part; a query meets vectors of its own length only. Scores are
    exact, and compared as such up to 38 digits; one that does not fit into a
    long is given as the nearest that does.
    Equal queries are searched once, with ``k`` + 1 rows, one of which may be
    the query itself.
    """
    spark, k = vectors.sparkSession, use.k + 1
    usable = _usable(vectors, use)
    count = max(1, usable.count())
    # The hash as a share of its range; a shell ends where the share passes its limit.
    share = (F.xxhash64("vec_id", "own").cast("double") / 2.0**64) + 0.5
    limits = [min(1.0, use.first_shell / count)]
    while limits[-1] < 1:
        limits.append(min(1.0, limits[-1] * use.growth))
    shell = F.size(F.filter(F.array(*[F.lit(v) for v in limits[:-1]]).cast("array<double>"), lambda v: v < share))
    rows = stage(usable.withColumn("shell", shell), "segments-rows", partition_by="shell")
    asked = rows.filter(F.col("vec_id") % every == 0).select("vec_id", "own", "x").distinct()
    asked = stage(asked, "segments-asked")
    classes = stage(asked.groupBy("x").agg(F.count("*").alias("rows")).withColumn("class_id", F.monotonically_increasing_id()), "segments-classes")
    members = stage(asked.join(classes, "x").select(F.col("vec_id").alias("query_id"), "class_id", "own"), "segments-members")

    sizes = classes.agg(F.count("*").alias("n"), F.sum(F.size("x") * 8 + 24).alias("bytes")).first()
    groups = max(1, -(-(sizes["bytes"] or 0) * 5 // (4 * use.group_bytes)))
    best = spark.createDataFrame([], FOUND + ", place int")
    near = F.col("score").cast("double")
    below = F.when(F.abs(near) < EXACT, near).otherwise(near - F.abs(near) * 2.0**-52)
    for number in range(len(limits) if sizes["n"] else 0):
        floors = best.filter(F.col("place") == k).select("class_id", below.alias("floor"), F.col("vec_id").alias("floor_id"))
        known = stage(classes.join(floors, "class_id", "left").select(
            F.pmod(F.xxhash64("class_id"), F.lit(groups)).alias("group"), "class_id", "x",
            F.coalesce("floor", F.lit(float("-inf"))).alias("floor"), F.coalesce("floor_id", F.lit(LIMIT - 1)).alias("floor_id"),
        ), "segments-known", partition_by="group")
        found = [best.select("class_id", "vec_id", "own", "score")]
        for group in range(groups):
            queries = known.filter(F.col("group") == group).select("class_id", "x", "floor", "floor_id").toArrow()
            if queries.num_rows:
                found.append(stage(_search(rows.filter(F.col("shell") == number), queries, use), "segments-found"))
        together = found[0]
        for part in found[1:]:
            together = together.union(part)
        best = stage(_best(together, k), "segments-best")

    others = members.join(best.withColumnRenamed("own", "row_own"), "class_id").filter((F.col("vec_id") != F.col("query_id")) | (F.col("row_own") != F.col("own")))
    order = Window.partitionBy("query_id", "own").orderBy("place")
    fits = F.greatest(F.least("score", F.lit(str(LIMIT - 1)).cast("decimal(38,0)")), F.lit(str(-LIMIT)).cast("decimal(38,0)"))
    ranked = others.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= use.k)
    return ranked.select("query_id", "rank", "vec_id", fits.cast("long").alias("score"))
