"""Loading only what is new, with the same result as loading everything.

The jobs find what is new by what arrived (see ``arrivals``); the selections by
a date mark here lose rows that arrive later than they allow for.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.scalars import calendar_parts, literal_like
from granary.operators.members import Ids
from granary.session import settings
from granary.sinks.lake import rebalanced
from granary.sinks.versions import NO_VALUE, Draft, Version, VersionedTable, part_name

# Fixed value: the mark before anything was loaded.
BEGINNING = "1900-01-01"

FACT_PARTITIONS = ("ano", "mes", "dia")

# Files that a partition may have, on average, for its old rows to be written as they lie.
FILES_KEPT = 4
# Of their files, most that a task reads and sorts by partition.
KEPT_BYTES = 2**26


def high_water_mark(facts: DataFrame, column: str = "data_venda") -> DataFrame:
    """One row with the latest loaded moment, or the beginning of time."""
    kind = facts.schema[column].dataType
    return facts.agg(F.coalesce(F.max(column), literal_like(BEGINNING, kind)).alias("max_date"))


def sales_after(sales: DataFrame, mark: dt.datetime) -> DataFrame:
    """Strictly later sales. Loses rows that share the mark; see :func:`sales_since`."""
    return sales.filter(F.col("data_venda") > literal_like(mark, sales.schema["data_venda"].dataType))


def lookback_start(mark: dt.datetime, lookback_days: int) -> dt.datetime:
    return mark if mark.year <= 1900 else mark - dt.timedelta(days=lookback_days)


def sales_since(sales: DataFrame, mark: dt.datetime, lookback_days: int) -> DataFrame:
    """Sales from ``lookback_days`` before the mark on, the mark included.

    Only sale headers are filtered; the join with the lines limits the lines.
    """
    earliest = lookback_start(mark, lookback_days)
    return sales.filter(F.col("data_venda") >= literal_like(earliest, sales.schema["data_venda"].dataType))


def merge_calendar(existing: DataFrame, sales: DataFrame) -> DataFrame:
    """The calendar with the dates of ``sales`` added; no date is ever dropped."""
    new = sales.select(F.to_date("data_venda").alias("data")).filter(F.col("data").isNotNull())
    days = existing.select("data").union(new).distinct()
    return days.withColumns(calendar_parts(F.col("data")))


def load_facts(
    table: VersionedTable,
    base: Version,
    batch: DataFrame,
    changed: DataFrame | Ids,
    days: Iterable[Mapping],
    metrics: dict[str, Column] | None = None,
    in_place: bool = False,
) -> tuple[Draft, list[str]]:
    """The fact's next version with ``batch`` in it, written but not committed, and the partitions it replaces.

    Sales are replaced whole: all old lines of a sale in ``changed(venda_id)``
    go, its new valid lines come. ``days`` are those that hold either; only they
    are read and written, once, and a day that loses its last sale is gone. A
    second run changes nothing. Old lines are written by the tasks that read
    them, and only the batch moves, to few tasks for each day; a load adds some
    file to a day. Once days have more than ``FILES_KEPT`` of them, or if there
    are too many changed ids to look them up where the lines lie, all lines of a
    day move together and become few files again. ``metrics`` and ``new_rows``
    are of the batch. ``in_place``: the batch lies together by partition as the
    old lines do, so no line has to move.
    """
    # Sales without a date are few; their day is not noted per sale.
    undated = {part for part in base.folders if NO_VALUE in part}
    parts = sorted({part_name(base.partition_by, day) for day in days} | undated)
    lying, ids, new = table.read(base, parts), Ids.of(changed), batch.withColumn("_new", F.lit(True))
    old = ids.without(lying, "venda_id").withColumn("_new", F.lit(False))
    if not in_place and ids.words is not None and len(lying.inputFiles()) <= FILES_KEPT * len(parts):
        new, in_place = rebalanced(new, base.partition_by), True
    merged = old.unionByName(new, allowMissingColumns=True)
    seen = {"new_rows": F.count_if("_new"), **(metrics or {})}
    with settings(table.spark, {"spark.sql.files.maxPartitionBytes": str(KEPT_BYTES)} if in_place else {}):
        return table.write(merged, base.partition_by, seen, base, parts, ["_new"], in_place), parts


def of_batch(value: Column) -> Column:
    """A value of the batch's rows, NULL in the old ones; for ``metrics`` of :func:`load_facts`."""
    return F.when(F.col("_new"), value)
