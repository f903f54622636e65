"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep, per key, the row with the greatest ``order_by``; NULLs count as oldest.

    An aggregate rather than a ranking window: each task first reduces its own
    rows, so a key that holds a third of the table sends one row per task over
    the network. Rows are sorted by key on both sides, in their own tasks, since
    structs cannot be compared in a hash table. The other columns
    follow in the compared struct, which settles ties the same way every run.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    newest = F.max(F.struct(*order_by, *rest)).alias("_newest")
    grouped = df.groupBy(*keys).agg(newest)
    return grouped.select(
        *[F.col(c) if c in keys else F.col(f"_newest.`{c}`").alias(c) for c in df.columns]
    )
