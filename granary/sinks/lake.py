"""Parquet writers.

Each write runs its plan once: row counts are observed while the files are
written, so nothing is counted by running the plan again.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from granary.session import CLEANING, scratch_path, settings
from granary.sources.lake import note_schema

COMPRESSION = "snappy"
# Of scratch and versioned tables, which only Spark reads and which are written again often.
DENSE = "zstd"
MAX_ROWS_PER_FILE = 20_000_000


@dataclass(frozen=True)
class WriteResult:
    table: str
    path: str
    rows: int
    status: str
    metrics: dict = field(default_factory=dict)
    # The folder this write filled, where that is only a part of ``path``.
    folder: str | None = None


def rebalanced(frame: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Few, evenly sized files per partition.

    A rebalance, not a repartition: a partition with a third of all rows is
    split over many tasks at run time, and small ones share a task.
    """
    return frame.hint("rebalance", *keys)


def _observed(frame: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, Observation]:
    observation = Observation(f"write-{uuid.uuid4().hex}")
    columns = [F.count(F.lit(1)).alias("rows")]
    columns += [expr.alias(name) for name, expr in metrics.items()]
    return frame.observe(observation, *columns), observation


def _save(
    frame: DataFrame, path: str, partition_by: Sequence[str], dynamic: bool, by_folder: bool = False, compression: str = COMPRESSION
) -> None:
    writer = (
        frame.write.mode("overwrite")
        .option("compression", compression)
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    # Where each folder's rows already share a task, merging tasks would not
    # save a file, only make fewer tasks write them.
    with settings(frame.sparkSession, CLEANING | ({"spark.sql.adaptive.coalescePartitions.enabled": "false"} if by_folder else {})):
        writer.parquet(path)


def save_observed(
    frame: DataFrame, path: str, partition_by: Sequence[str], metrics: dict[str, Column], hidden: Sequence[str] = (), in_place: bool = False
) -> tuple[int, dict]:
    """Write to a new folder; rows and ``metrics`` of what was written. ``hidden`` columns are counted, not written.

    ``in_place``: the tasks that have the rows write them, without a shuffle;
    for rows that already lie together by partition, or files that nobody keeps.
    """
    observed, seen = _observed(frame if in_place else rebalanced(frame, partition_by), metrics)
    # A union of frames of one task each would itself become one task.
    with settings(frame.sparkSession, {"spark.sql.unionOutputPartitioning": "false"} if in_place else {}):
        _save(observed.drop(*hidden), path, partition_by, dynamic=False, by_folder=bool(partition_by) and not in_place, compression=DENSE)
    found = dict(seen.get)
    return found.pop("rows", 0) or 0, found


def write_bronze(
    frame: DataFrame,
    root: str,
    table: str,
    day: dt.date | None = None,
    date_column: str | None = None,
) -> WriteResult:
    """Write one extract to its date folder, or many dates at once by ``date_column``.

    Folders are replaced, so a rerun of a date leaves no second copy; dates
    without rows are not touched, and an empty extract writes nothing.
    """
    if day is not None:
        parts = {"year": F.lit(str(day.year)), "month": F.lit(f"{day:%m}"), "day": F.lit(f"{day:%d}")}
    else:
        moment = F.col(date_column)
        patterns = {"year": "yyyy", "month": "MM", "day": "dd"}
        parts = {name: F.date_format(moment, pattern) for name, pattern in patterns.items()}
    path = f"{root}/{table}"
    dated = frame.withColumns(parts)
    observed, seen = _observed(dated if day is not None else rebalanced(dated, list(parts)), {})
    _save(observed, path, list(parts), dynamic=True, by_folder=day is None)
    rows = seen.get.get("rows", 0)
    folder = f"{path}/year={day.year}/month={day:%m}/day={day:%d}" if day is not None else None
    if folder and rows:
        note_schema(frame.sparkSession, folder, frame.schema)
    return WriteResult(table, path, rows, "success" if rows else "empty", folder=folder)


def overwrite_partitions(
    frame: DataFrame,
    path: str,
    table: str,
    partition_by: Sequence[str],
    metrics: dict[str, Column] | None = None,
) -> WriteResult:
    """Replace exactly the partitions that ``frame`` has rows for."""
    observed, seen = _observed(rebalanced(frame, partition_by), metrics or {})
    _save(observed, path, partition_by, dynamic=True, by_folder=True)
    return _result(table, path, seen)


def replace_table(
    frame: DataFrame,
    path: str,
    table: str,
    partition_by: Sequence[str] = (),
    metrics: dict[str, Column] | None = None,
) -> WriteResult:
    """Replace the whole table; skip it, and keep the old files, if there are no rows.

    The rows go to a scratch folder first. Only then is it known whether there
    are any, the target may be one of the tables the plan reads, and a failed
    plan leaves the old table as it was. Publishing copies files, without a
    shuffle.
    """
    staged, result = stage(frame, table, partition_by, metrics)
    if result.rows:
        _save(staged, path, partition_by, dynamic=False)
    return WriteResult(table, path, result.rows, result.status, result.metrics)


def stage(
    frame: DataFrame,
    purpose: str,
    partition_by: Sequence[str] = (),
    metrics: dict[str, Column] | None = None,
) -> tuple[DataFrame, WriteResult]:
    """Write to a fresh scratch folder and read it back, with the same columns.

    Without partitions the tasks write the rows as they lie: another shuffle
    would only save files that nobody keeps.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, purpose)
    observed, seen = _observed(rebalanced(frame, partition_by) if partition_by else frame, metrics or {})
    _save(observed, path, partition_by, dynamic=False, by_folder=bool(partition_by), compression=DENSE)
    result = _result(purpose, path, seen)
    return spark.read.schema(frame.schema).parquet(path).select(*frame.columns), result


def _result(table: str, path: str, seen: Observation) -> WriteResult:
    metrics = dict(seen.get)
    rows = metrics.pop("rows", 0) or 0
    return WriteResult(table, path, rows, "success" if rows else "skipped", metrics)


def compact(spark: SparkSession, path: str, partition_by: Sequence[str]) -> WriteResult:
    """Rewrite a table with few files per partition."""
    frame = spark.read.parquet(path)
    return replace_table(frame, path, path.rstrip("/").rsplit("/", 1)[-1], partition_by)
