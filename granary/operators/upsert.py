"""Replace rows by key, and find out which partitions that touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def upsert(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    replaced: DataFrame | None = None,
) -> DataFrame:
    """``existing`` without the keys of ``replaced`` (default: of ``batch``), plus ``batch``.

    ``replaced`` matters when a key may come back with fewer rows than before,
    or with none. Loading the same batch twice changes nothing.
    """
    gone = (batch if replaced is None else replaced).select(*keys).distinct()
    return existing.join(gone, list(keys), "left_anti").select(*existing.columns).unionByName(
        batch.select(*existing.columns)
    )


def touched_partitions(
    existing: DataFrame, batch: DataFrame, changed_keys: DataFrame, keys: Sequence[str], partition_by: Sequence[str]
) -> DataFrame:
    """Partitions that hold new rows or old rows of the changed keys.

    Old rows are looked for in the whole table, reading only the key and
    partition columns: a row may have moved to another partition.
    """
    old = existing.select(*keys, *partition_by).join(
        changed_keys.select(*keys).distinct(), list(keys), "left_semi"
    )
    return batch.select(*partition_by).distinct().union(old.select(*partition_by).distinct()).distinct()
