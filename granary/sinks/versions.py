"""Tables that are replaced in one step, and only by a writer who saw the newest state.

Files are written once, into a folder that no reader knows yet. A commit then
adds one small record: which folder holds each partition, and the schema. A new
version shares the folders of the partitions it did not touch. Whoever reads
takes the newest record, so a failure at any step leaves the version before it.

A record's name is the version's number, and it is put in place by a rename that
fails if the name is taken. A writer names the version it started from; if
another one came in between, its commit fails with :class:`Conflict` and its
files are never seen. That holds where the file system renames in one step and
refuses an existing target, as HDFS does.

The catalog shows a version as a table of its own and the table's name as a view
of it, since a view is replaced by one catalog call, whatever the number of
partitions.
"""

from __future__ import annotations

import datetime as dt
import heapq
import json
import uuid
from collections.abc import Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.sinks.lake import WriteResult, save_observed
from granary.sources.files import Files
from granary.sources.lake import PARTITIONS_AT_ONCE, replace_view

# Reading by whole partitions. Bytes of files a task should have, or, while cores
# are idle, at least; of a partition that is read whole, and of all such, at most.
TASK_BYTES, LEAST_BYTES, WHOLE_BYTES, ALL_BYTES = 2**25, 2**22, 2**28, 200 * 2**27
MOST_TASKS = 200

# Folder name of a partition value that is NULL; fixed by Spark's file layout.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Conflict(RuntimeError):
    """Another writer committed after this one had read the table."""


@dataclass(frozen=True)
class Version:
    """``folders``: partition (``ano=2025/mes=1``; empty for a table without partitions) to the folder of the version that wrote it."""

    number: int
    schema: T.StructType
    partition_by: tuple[str, ...]
    folders: Mapping[str, str]
    at: str
    notes: Mapping = field(default_factory=dict)

    def as_json(self) -> str:
        return json.dumps({**self.__dict__, "schema": self.schema.jsonValue(), "partition_by": list(self.partition_by)})

    @staticmethod
    def from_json(text: str) -> Version:
        known = json.loads(text)
        return Version(**{**known, "schema": T.StructType.fromJson(known["schema"]), "partition_by": tuple(known["partition_by"])})


def part_name(partition_by: Sequence[str], row: Row | Mapping) -> str:
    """The folder part of a partition, as Spark writes it for whole numbers and plain words."""
    return "/".join(f"{key}={NO_VALUE if row[key] is None else row[key]}" for key in partition_by)


def changed_parts(old: Version | None, new: Version) -> tuple[set[str], set[str]]:
    """Partitions that are new or were written again, and those that are gone."""
    before = dict(old.folders) if old else {}
    return {p for p, f in new.folders.items() if before.get(p) != f}, set(before) - set(new.folders)


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.name, self.root = spark, name, f"{root.rstrip('/')}/{name}"
        self._files = Files(spark, self.root)

    def numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._files.names(f"{self.root}/_versions") if n.endswith(".json")]

    def version(self, number: int) -> Version | None:
        """A version by its number, if its record is still kept."""
        return Version.from_json(self._files.read(self._record(number))) if number in self.numbers() else None

    def current(self) -> Version | None:
        numbers = self.numbers()
        return self.version(max(numbers)) if numbers else None

    def _record(self, number: int) -> str:
        return f"{self.root}/_versions/{number:08d}.json"

    def read(self, version: Version | None = None, parts: Collection[str] | None = None) -> DataFrame:
        """A version's rows, or those of some partitions only; other folders are not even listed.

        The schema comes from the record, so no file footer is opened to plan a
        read, and columns that older partitions lack are NULL there.
        """
        version = version or self.current()
        names = [f.name for f in version.schema.fields]
        folders = version.folders if parts is None else {p: f for p, f in version.folders.items() if p in set(parts)}
        if not folders:
            return self.spark.createDataFrame([], version.schema)
        reader = self.spark.read.schema(version.schema)
        written = set(folders.values())
        if parts is None and len(written) == 1 and next(iter(written)).startswith(f"v={version.number}-"):
            # This version wrote all of it, so the folder holds nothing else.
            return reader.parquet(f"{self.root}/{next(iter(written))}").select(*names)
        paths = ["/".join(x for x in (self.root, f, p) if x) for p, f in sorted(folders.items())]
        return reader.option("basePath", self.root).parquet(*paths).select(*names)

    def read_whole(self, version: Version | None = None, parts: Collection[str] | None = None) -> tuple[list[DataFrame], DataFrame | None]:
        """The rows in frames of one task each that share no partition, and those of partitions too large for that.

        What is grouped by partition, and more, inside such a frame needs no
        shuffle, and may be written by partition as it lies.
        """
        version = version or self.current()
        folders = version.folders if parts is None else {p: f for p, f in version.folders.items() if p in set(parts)}
        sizes = {p: sum(self._files.sizes("/".join(x for x in (self.root, f, p) if x))) for p, f in folders.items()}
        small, total = [], 0
        for part in sorted(sizes, key=lambda p: (sizes[p], p)):
            if sizes[part] <= WHOLE_BYTES and total + sizes[part] <= ALL_BYTES:
                small.append(part)
                total += sizes[part]
        cores = self.spark.sparkContext.defaultParallelism
        wanted = max(total // TASK_BYTES, min(cores, total // LEAST_BYTES))
        bins: list[tuple[int, list[str]]] = [(0, []) for _ in range(max(1, min(wanted, len(small), MOST_TASKS)))]
        for part in reversed(small):
            size, names = heapq.heappop(bins)
            heapq.heappush(bins, (size + sizes[part], [*names, part]))
        large = sizes.keys() - set(small)
        if len(bins) == 1 and not large:
            return [self.read(version, parts).coalesce(1)], None
        return [self.read(version, names).coalesce(1) for _, names in bins if names], self.read(version, large) if large else None

    def write(
        self,
        frame: DataFrame,
        partition_by: Sequence[str] = (),
        metrics: Mapping[str, Column] | None = None,
        base: Version | None = None,
        replaced: Iterable[str] | None = None,
        hidden: Sequence[str] = (),
        in_place: bool = False,
    ) -> Draft:
        """Write the files of the version after ``base``, not yet visible.

        ``replaced``: the partitions that ``frame`` stands for, which may leave
        some of them without rows; the others stay. None: the whole table.
        ``hidden``: columns that only ``metrics`` need. ``in_place``: see
        :func:`save_observed`.
        """
        if replaced is not None and base:
            frame = _fitting(frame, base.schema)
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in frame.schema.fields if f.name not in hidden])
        folder = f"v={(base.number if base else 0) + 1}-{uuid.uuid4().hex[:12]}"
        rows, seen = save_observed(frame, f"{self.root}/{folder}", partition_by, dict(metrics or {}), hidden, in_place)
        if partition_by:
            folders = {part: folder for part in self._files.folders_below(f"{self.root}/{folder}", len(partition_by))}
        else:
            folders = {"": folder} if rows else {}
        if replaced is not None and base:
            gone = set(replaced)
            folders = {p: f for p, f in base.folders.items() if p not in gone} | folders
        return Draft(self, base, Version((base.number if base else 0) + 1, schema, tuple(partition_by), folders, ""), rows, seen)

    def keep(self, base: Version) -> Draft:
        """The same rows as a new version, to note something."""
        return Draft(self, base, Version(base.number + 1, base.schema, base.partition_by, base.folders, ""), 0, {})

    def publish(self, database: str) -> None:
        """Let the catalog show the newest version under the table's name, in one step.

        The tables of the newest two versions stay, so that queries that have
        already looked up the view end well.
        """
        version, spark = self.current(), self.spark
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        own = f"{self.name}__v{version.number}"
        target = f"`{database}`.`{own}`"
        if not spark.catalog.tableExists(f"{database}.{own}"):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in version.schema.fields)
            keys = f"PARTITIONED BY ({', '.join(f'`{k}`' for k in version.partition_by)})" if version.partition_by else ""
            location = self.root if version.partition_by else f"{self.root}/{next(iter(version.folders.values()))}"
            spark.sql(f"CREATE TABLE {target} ({columns}) USING parquet {keys} LOCATION '{location}'")
        if version.partition_by:
            parts = sorted(version.folders.items())
            for low in range(0, len(parts), PARTITIONS_AT_ONCE):
                specs = [f"PARTITION ({_spec(p)}) LOCATION '{self.root}/{f}/{p}'" for p, f in parts[low : low + PARTITIONS_AT_ONCE]]
                spark.sql(f"ALTER TABLE {target} ADD IF NOT EXISTS {' '.join(specs)}")
        replace_view(spark, database, self.name, own)
        for row in spark.catalog.listTables(database, f"{self.name}__v*"):
            if int(row.name.rsplit("__v", 1)[1]) < version.number - 1:
                spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{row.name}`")

    def compact(self, at: dt.datetime, target_bytes: int) -> list[str]:
        """Write the partitions of small files again; returns them.

        A partition is due if it has more than one file and could do with half
        as many of ``target_bytes``. The others keep their files, names and all.
        """
        base = self.current()
        due = []
        for part, folder in base.folders.items():
            sizes = self._files.sizes("/".join(x for x in (self.root, folder, part) if x))
            if len(sizes) > 1 and 2 * max(1, -(-sum(sizes) // target_bytes)) <= len(sizes):
                due.append(part)
        if due:
            self.write(self.read(base, due), base.partition_by, base=base, replaced=due).commit(at)
        return due

    def expire(self, before: dt.datetime, keep: int = 2) -> list[str]:
        """Forget versions committed before a moment, but for the newest ``keep``; returns the folders that went.

        Folders that no record names go too, if a version of their number exists:
        their writers failed, or will fail to commit. Those of versions still to
        come are left alone.
        """
        numbers = sorted(self.numbers())
        known = {n: self.version(n) for n in numbers}
        old = [n for n in numbers[:-keep] if known[n].at < before.isoformat()]
        needed = {f for n in numbers if n not in old for f in known[n].folders.values()}
        written = {f: int(f[2:].split("-")[0]) for f in self._files.names(self.root) if f.startswith("v=")}
        gone = [f for f, number in written.items() if numbers and number <= numbers[-1] and f not in needed]
        for number in old:
            self._files.delete(self._record(number))
        for folder in gone:
            self._files.delete(f"{self.root}/{folder}")
        return gone


@dataclass(frozen=True)
class Draft:
    """Files that a commit makes visible. ``rows``: rows written."""

    table: VersionedTable
    base: Version | None
    version: Version
    rows: int
    metrics: Mapping

    def read(self, parts: Collection[str] | None = None) -> DataFrame:
        return self.table.read(self.version, parts)

    def commit(self, at: dt.datetime, notes: Mapping | None = None) -> Version:
        """Make the draft the newest version; :class:`Conflict` if ``base`` no longer is."""
        kept = dict(self.base.notes) if self.base else {}
        version = Version(self.version.number, self.version.schema, self.version.partition_by, self.version.folders, at.isoformat(), {**kept, **(notes or {})})
        numbers = self.table.numbers()
        newest = max(numbers) if numbers else 0
        if newest != version.number - 1 or not self.table._files.put_new(self.table._record(version.number), version.as_json()):
            raise Conflict(f"{self.table.name}: version {version.number} was committed by another run")
        return version

    def result(self, rows: int | None = None) -> WriteResult:
        count = self.rows if rows is None else rows
        return WriteResult(self.table.name, self.table.root, count, "success" if count else "skipped", dict(self.metrics))


def _fitting(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame with the columns and types of ``schema`` first, NULL where it lacks them, and its own others after them."""
    own = dict(frame.dtypes)

    def fitting(f: T.StructField) -> Column:
        if own.get(f.name) == f.dataType.simpleString():
            return F.col(f.name)
        return (F.col(f.name) if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name)

    known = [fitting(f) for f in schema.fields]
    return frame.select(*known, *[c for c in frame.columns if c not in set(schema.fieldNames())])


def _spec(part: str) -> str:
    pairs = [p.split("=", 1) for p in part.split("/")]
    return ", ".join(f"`{k}` = {'NULL' if v == NO_VALUE else repr(v)}" for k, v in pairs)


def replace(
    table: VersionedTable,
    frame: DataFrame,
    at: dt.datetime,
    partition_by: Sequence[str] = (),
    metrics: Mapping[str, Column] | None = None,
    replaced: Iterable[str] | None = None,
    notes: Mapping | None = None,
) -> WriteResult:
    """Write and commit; without rows nothing is committed and the old version stays, unless ``replaced`` names partitions to empty."""
    base = table.current()
    draft = table.write(frame, partition_by, metrics, base, replaced)
    if draft.rows or (base and draft.version.folders != base.folders and replaced is not None):
        draft.commit(at, notes)
    return draft.result()
