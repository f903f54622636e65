"""References between tables, and required values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphan_report(references: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Per reference (name, child, key, parent, key): child rows whose key has no parent, and the distinct keys among them.

    Every table is read once, however many references it takes part in: each
    row gives its keys, tagged with the reference and the side, and one
    aggregate brings both sides of all references together. Rows are counted
    per key inside each task, so a key with very many rows meets its parent
    once. A frame that serves several references is told by being the same
    object. NULL keys refer to nothing.
    """
    tags: dict[int, tuple[DataFrame, list]] = {}
    for name, child, child_key, parent, parent_key in references:
        for frame, key, rows, known in ((child, child_key, 1, 0), (parent, parent_key, 0, 1)):
            tag = F.struct(F.lit(name).alias("referencia"), F.col(key).cast("string").alias("_key"), F.lit(rows).cast("long").alias("_rows"), F.lit(known).alias("_known"))
            tags.setdefault(id(frame), (frame, []))[1].append(tag)
    sides = [frame.select(F.inline(F.array(*own))) for frame, own in tags.values()]
    keys = reduce(DataFrame.union, sides).filter(F.col("_key").isNotNull()).groupBy("referencia", "_key").agg(F.sum("_rows").alias("_rows"), F.max("_known").alias("_known"))
    lost = (F.col("_known") == 0) & (F.col("_rows") > 0)
    found = keys.groupBy("referencia").agg(F.sum(F.when(lost, F.col("_rows"))).alias("_lost"), F.count_if(lost).alias("_keys"))
    spark = references[0][1].sparkSession
    names = spark.createDataFrame([(r[0],) for r in references], "referencia string")
    zero = F.lit(0).cast("long")
    return names.join(found, "referencia", "left").select(
        "referencia", F.coalesce("_lost", zero).alias("linhas_orfas"), F.coalesce("_keys", zero).alias("chaves_orfas")
    )


def null_counts(name: str, df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column with its NULLs, all counted in one pass."""
    counted = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in required]
    )
    return counted.unpivot("_rows", list(required), "coluna", "nulos").select(
        F.lit(name).alias("tabela"), "coluna", "nulos", F.col("_rows").alias("linhas")
    )
