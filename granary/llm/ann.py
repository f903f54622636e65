"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform)
turns a unit vector; its nearest signed axis is the hash. Several tables, each
with its own rotations, hold every vector once. A query probes the buckets of
its best axes in every table (multiprobe), in rounds: its own buckets first, then
each time ``growth`` times as many. Candidates are ranked by their exact Euclidean
distance inside the bucket; only the best few leave it, and from the second round
on only those no farther than the worst of the best found before. A round thus
lets out some ``growth`` x k rows a query, however many buckets it looks into.
Rows and queries of a bucket are cut into blocks, and each pair of blocks meets
in one task.

The number of buckets follows the number of rows: with more rows the hash joins
the axes of two rotations, the second over as many dimensions as needed. The
number of probes is set on a bounded sample, so that the sample's neighbours
are found with the wanted recall.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import stage


@dataclass(frozen=True)
class Settings:
    """``bucket``: rows wanted in a bucket; ``sample``, ``sample_queries``: size of the sample that sets the probes.

    ``block``: most rows, and most queries, of a bucket that meet in a task, about; ``slice``: queries compared at once;
    ``growth``: probes of a round against those before it.
    """

    k: int = 10
    tables: int = 8
    bucket: int = 1000
    recall: float = 0.95
    sample: int = 20_000
    sample_queries: int = 200
    block: int = 4096
    slice: int = 256
    growth: int = 16
    seed: int = 11


class Hasher:
    """``tables`` hash functions over vectors of ``size`` dimensions, with about ``buckets`` values each."""

    def __init__(self, size: int, tables: int, buckets: int, seed: int):
        self.size, self.tables = size, tables
        self.padded = 1 << max(1, (size - 1).bit_length())
        # Axes of the first and of the second rotation that count.
        self.axes = [min(self.padded, max(1, -(-buckets // 2)))]
        if buckets > 2 * self.padded:
            self.axes.append(min(self.padded, -(-buckets // (4 * self.padded))))
        signs = np.random.default_rng(seed).integers(0, 2, (tables, len(self.axes), 3, self.padded))
        self.signs = (2 * signs - 1).astype(np.float32)

    def rotated(self, unit: np.ndarray, table: int, part: int) -> np.ndarray:
        x = np.zeros((len(unit), self.padded), np.float32)
        x[:, : self.size] = unit
        for signs in self.signs[table, part]:
            x = x * signs
            width = 1
            while width < self.padded:
                x = x.reshape(len(unit), -1, 2, width)
                x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(len(unit), -1)
                width *= 2
            x /= np.sqrt(np.float32(self.padded))
        return x[:, : self.axes[part]]

    def ranked(self, unit: np.ndarray, table: int, probes: int) -> np.ndarray:
        """The ``probes`` buckets nearest to every vector, nearest first; a signed axis is nearer the larger its coordinate."""
        scores = None
        for part in range(len(self.axes)):
            x = self.rotated(unit, table, part)
            own = np.concatenate([x, -x], 1)
            scores = own if scores is None else (scores[:, :, None] + own[:, None, :]).reshape(len(unit), -1)
        if probes == 1:
            return scores.argmax(1)[:, None]
        return np.argsort(-scores, 1, kind="stable")[:, :probes]

    @property
    def buckets(self) -> int:
        return int(np.prod([2 * a for a in self.axes]))


def unit_vectors(x: np.ndarray) -> np.ndarray:
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def probes_for(hasher: Hasher, sample: np.ndarray, queries: np.ndarray, use: Settings) -> int:
    """Least number of probes that finds ``recall`` of the sample's own neighbours; all buckets if none does."""
    k = min(use.k, len(sample) - 1)
    if k < 1:
        return 1
    unit, rank = unit_vectors(sample), np.full((len(queries), k), hasher.buckets)
    squares = (sample**2).sum(1)
    near = np.argsort((squares - 2 * sample[queries] @ sample.T), 1)
    near = np.stack([row[row != q][:k] for row, q in zip(near, queries)])
    for table in range(hasher.tables):
        home = hasher.ranked(unit, table, 1)[:, 0]
        order = hasher.ranked(unit[queries], table, hasher.buckets)
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(order.shape[1])[None], 1)
        rank = np.minimum(rank, np.take_along_axis(place, home[near], 1))
    return int(np.quantile(rank, use.recall, method="higher")) + 1


def _usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of the vectors that take part: no NULL or non-finite component, not zero, not empty."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")).filter("vec_id IS NOT NULL").filter(F.coalesce(fine, F.lit(False)))


def _matrix(column) -> np.ndarray:
    return np.array(column.tolist(), float).reshape(len(column), -1)


def _hashed(classes: DataFrame, hasher: Hasher, probes: int) -> DataFrame:
    """``bucket`` (of all tables), ``place`` (0 for the nearest), and the columns of ``classes(class_id, first_id, v)``: every vector in its ``probes`` nearest buckets of each table."""

    def run(frames):
        for rows in frames:
            for low in range(0, len(rows), 2000):
                part = rows.iloc[low : low + 2000]
                unit = unit_vectors(_matrix(part["v"]))
                for table in range(hasher.tables):
                    own = hasher.ranked(unit, table, probes).astype(np.int64) + table * hasher.buckets
                    several = part.iloc[np.repeat(np.arange(len(part)), own.shape[1])]
                    yield several.assign(bucket=own.ravel(), place=np.tile(np.arange(own.shape[1]), len(part)))

    kind = classes.schema["v"].dataType.simpleString()
    return classes.select("class_id", "first_id", "v").mapInPandas(run, f"class_id long, first_id long, v {kind}, bucket long, place int")


def _sample(classes: DataFrame, count: int, use: Settings) -> DataFrame:
    """About the ``sample`` vectors of the lowest hashes; others are left out by a threshold, so that no task hands over more than its share."""
    share = min(1.0, (use.sample + 6 * use.sample**0.5) / max(1, count))
    key = F.xxhash64("v")
    some = classes if share == 1 else classes.filter(key < int(-(2**63) + share * 2**64))
    return some.orderBy(key, "class_id").select("v").limit(use.sample)


def _compare(queries: pd.DataFrame, rows: pd.DataFrame, use: Settings) -> pd.DataFrame:
    """``q, class_id, first_id, score``: the k + 1 rows nearest to each query, none beyond its ``bound``; ties to smaller ids.

    A matrix product rules out rows that lie too far even with its rounding; the others get their exact distance.
    """
    most, x = use.k + 1, _matrix(rows["v"])
    ids, firsts, found = rows["class_id"].to_numpy(), rows["first_id"].to_numpy(), []
    squares = (x**2).sum(1)
    for low in range(0, len(queries), use.slice):
        part = queries.iloc[low : low + use.slice]
        v, bound = _matrix(part["v"]), part["bound"].to_numpy(float)
        own = (v**2).sum(1)
        near = own[:, None] + squares - 2 * v @ x.T
        near[~np.isfinite(near)] = -np.inf  # beyond the range of squares: to be looked at
        limit = bound**2
        if len(x) > most:
            limit = np.minimum(limit, np.partition(near, most - 1, 1)[:, most - 1])
        q, r = np.nonzero(near <= (limit + 1e-12 * len(x[0]) * (own + squares.max()))[:, None])
        far = np.sqrt(((x[r] - v[q]) ** 2).sum(1))
        order = np.lexsort((ids[r], firsts[r], far, q))
        q, r, far = q[order], r[order], far[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        best = (place < most) & (far <= bound[q])
        found.append(pd.DataFrame({"q": part["class_id"].to_numpy()[q[best]], "class_id": ids[r[best]], "first_id": firsts[r[best]], "score": far[best]}))
    return pd.concat(found)


def nearest(vectors: DataFrame, every: int = 100, use: Settings = Settings()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for every row whose id is divisible by ``every``.

    ``vectors(vec_id, embedding, ...)``. Equal vectors form a class that is
    hashed and searched once; its k + 1 smallest ids stand for it, which is all
    that any query's k nearest can hold. Vectors that are NULL, zero or hold
    NULL or non-finite components take no part, nor do rows without id, nor
    vectors of another length than the commonest (of several, the smallest).
    Rows that repeat an id count once for each different vector. Ties go to the
    smaller id.
    """
    usable = _usable(vectors)
    sizes = usable.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    size = sizes["n"] if sizes else 1
    member = usable.filter(F.size("v") == size).distinct()
    kept = member.withColumn("_place", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("_place") <= use.k + 1)
    classes = kept.groupBy("v").agg(F.min("vec_id").alias("class_id"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
    # An id with two vectors may stand for both classes; the row number keeps them apart.
    classes = stage(classes, "ann-classes").withColumnRenamed("class_id", "first_id").withColumn("class_id", F.monotonically_increasing_id())
    asked = member.filter(F.col("vec_id") % every == 0)
    asked = stage(asked.join(classes.select("v", "class_id"), "v").select(F.col("vec_id").alias("query_id"), "class_id"), "ann-queries")
    searched = classes.join(asked.select("class_id").distinct(), "class_id", "left_semi")

    count = classes.count()
    hasher = Hasher(size, use.tables, max(1, count // use.bucket), use.seed)
    sample = _matrix(_sample(classes, count, use).toPandas()["v"]) if count else np.empty((0, size))
    probes = min(hasher.buckets, probes_for(hasher, sample, np.arange(min(use.sample_queries, len(sample))), use))

    homes = stage(_hashed(classes, hasher, 1).drop("place"), "ann-homes")
    probed = stage(_hashed(searched, hasher, probes).drop("first_id"), "ann-probes")
    in_blocks = F.ceil(F.count("*") / F.lit(use.block)).cast("int")
    row_blocks = homes.groupBy("bucket").agg(in_blocks.alias("rows"))
    most = use.k + 1

    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"q": [], "class_id": [], "first_id": [], "score": []})
        with np.errstate(over="ignore", invalid="ignore"):
            return _compare(queries, rows, use)

    near, low, high = None, 0, 1
    while low < probes:
        asking = probed.filter((F.col("place") >= low) & (F.col("place") < high)).drop("place")
        blocks = row_blocks.join(asking.groupBy("bucket").agg(in_blocks.alias("queries")), "bucket")
        if near is None:
            asking = asking.withColumn("bound", F.lit(float("inf")))
        else:
            # With k + 1 found, nothing beyond the last of them can be among the k + 1 nearest.
            bounds = near.groupBy(F.col("q").alias("class_id")).agg(F.when(F.count("*") == most, F.max("score")).otherwise(float("inf")).alias("bound"))
            asking = asking.join(bounds, "class_id", "left").fillna(float("inf"), ["bound"])
        hashed = F.xxhash64("class_id", F.lit(1))
        left = asking.join(blocks, "bucket").withColumn("a", F.pmod(hashed, F.col("queries")).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
        right = homes.join(blocks, "bucket").withColumn("b", F.pmod(hashed, F.col("rows")).cast("int")).withColumn("a", F.explode(F.sequence(F.lit(0), F.col("queries") - 1)))
        met = left.drop("rows", "queries").groupBy("bucket", "a", "b").cogroup(right.drop("rows", "queries").groupBy("bucket", "a", "b"))
        found = met.applyInPandas(search, "q long, class_id long, first_id long, score double")
        found = (found if near is None else found.unionByName(near)).distinct()
        best = Window.partitionBy("q").orderBy("score", "first_id", "class_id")
        near = stage(found.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= most).drop("_place"), "ann-found")
        low, high = high, high * use.growth
    near = near.join(classes.select("class_id", "ids"), "class_id").select("q", F.explode("ids").alias("vec_id"), "score")
    near = near.withColumn("_place", F.row_number().over(Window.partitionBy("q").orderBy("score", "vec_id"))).filter(F.col("_place") <= 2 * most)
    near = near.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    answer = asked.join(near.withColumnRenamed("q", "class_id"), "class_id")
    others = F.slice(F.filter("near", lambda n: n["vec_id"] != F.col("query_id")), 1, use.k)
    ranked = answer.select("query_id", F.posexplode(others).alias("rank", "n"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), "n.vec_id", "n.score")
