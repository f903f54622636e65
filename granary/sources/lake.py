"""Reading bronze folders and catalog tables."""

from __future__ import annotations

import datetime as dt
import json
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.scalars import convert_timestamps
from granary.schemas import GOLD, REPORTS, SILVER, TIMESTAMP_COLUMNS
from granary.session import configure
from granary.sources.files import Files

log = logging.getLogger(__name__)

EXTRACT_KEYS = ("year", "month", "day")
# Partitions in one catalog statement.
PARTITIONS_AT_ONCE = 500


class MissingColumns(ValueError):
    """A source lacks columns that its declared schema requires."""


def extract_folder(root: str, table: str, day: dt.date) -> str:
    return f"{root}/{table}/year={day.year}/month={day:%m}/day={day:%d}"


def latest_extract(spark: SparkSession, path: str) -> str | None:
    """Newest date folder below ``path``: three listings, whatever the number of files; none is opened."""
    files, folder = Files(spark, path), path
    for key in EXTRACT_KEYS:
        dated = {int(n.split("=")[1]): n for n in files.names(folder) if n.startswith(f"{key}=")}
        if not dated:
            return None
        folder = f"{folder}/{dated[max(dated)]}"
    return folder


def note_schema(spark: SparkSession, folder: str, schema: T.StructType) -> None:
    """Keep the schema of a date folder beside the data, so that readers need no footer."""
    path, day = folder.rsplit("/", 3)[0], "-".join(part.split("=")[1] for part in folder.rsplit("/", 3)[1:])
    Files(spark, path).put(f"{path}/_schemas/{day}.json", schema.json())


def noted_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """All columns of all extracts, from the notes; None if a folder has no note or a column changed its type.

    One row per different schema reaches the driver.
    """
    files = Files(spark, path)
    days = {"-".join(part.split("=")[1] for part in folder.split("/")) for folder in files.folders_below(path, len(EXTRACT_KEYS))}
    if not days or days - {n.removesuffix(".json") for n in files.names(f"{path}/_schemas")}:
        return None
    notes = spark.read.option("wholetext", True).text(f"{path}/_schemas").distinct().orderBy("value").collect()
    fields: dict[str, T.StructField] = {}
    for note in notes:
        for f in T.StructType.fromJson(json.loads(note["value"])).fields:
            if fields.setdefault(f.name, f).dataType != f.dataType:
                return None
    return T.StructType([*fields.values(), *[T.StructField(k, T.IntegerType()) for k in EXTRACT_KEYS]])


def read_bronze(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    only_latest: bool = False,
    merge_schema: bool = True,
) -> DataFrame:
    """All date folders of one table, with real timestamps and checked columns.

    ``only_latest`` reads the newest extract and looks at no other. That is what
    a table needs that is extracted in full every day, since each extract
    repeats all rows. Columns that only some extracts have are NULL in the
    others' rows; which there are is read from the notes of the writers, or
    where some are missing, from the footers of all files.
    """
    configure(spark)
    newest = latest_extract(spark, path) if only_latest else None
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if newest:
        frame = reader.option("basePath", path).parquet(newest)
    else:
        noted = noted_schema(spark, path) if merge_schema else None
        frame = spark.read.schema(noted).parquet(path) if noted else reader.parquet(path)
    frame = convert_timestamps(frame, TIMESTAMP_COLUMNS)
    return conform(frame, schema) if schema else frame


def _family(kind: T.DataType) -> str:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "time"
    if isinstance(kind, T.NumericType):
        return "number"
    return kind.typeName()


def conform(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Check required columns and bring numbers and flags to their declared types.

    Columns that the schema does not know stay, and are logged. Timestamps keep
    the kind they have, zoned or not. Text is never parsed here; a column of
    another kind than declared is logged as retyped and kept as it is.
    """
    present = {f.name: f.dataType for f in frame.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in present]
    if missing:
        raise MissingColumns(f"missing columns: {', '.join(missing)}")
    extra = [n for n in present if n not in schema.fieldNames() and n not in EXTRACT_KEYS]
    if extra:
        log.info("columns beyond the declared schema: %s", ", ".join(extra))
    retyped = [f.name for f in schema.fields if present[f.name] != f.dataType and _family(present[f.name]) != _family(f.dataType)]
    if retyped:
        log.warning("columns of another kind than declared: %s", ", ".join(retyped))
    casts = {}
    for f in schema.fields:
        found = present[f.name]
        both_numbers = _family(found) == _family(f.dataType) == "number"
        to_flag = isinstance(f.dataType, T.BooleanType) and _family(found) == "number"
        unknown = isinstance(found, T.NullType)
        if found != f.dataType and (both_numbers or to_flag or unknown):
            casts[f.name] = F.col(f.name).cast(f.dataType)
    return frame.withColumns(casts) if casts else frame


def table_exists(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.databaseExists(database) and spark.catalog.tableExists(f"{database}.{table}")


def read_layer_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    """A catalog table, or no rows with the declared columns if it cannot be loaded."""
    declared = {**SILVER, **GOLD, **REPORTS}[table]
    try:
        if table_exists(spark, database, table):
            return spark.table(f"{database}.{table}")
        reason = "not in the catalog"
    except AnalysisException as error:
        reason = str(error)
    log.warning("%s.%s is read as empty: %s", database, table, reason)
    return spark.createDataFrame([], declared)


def register_table(
    spark: SparkSession, database: str, table: str, path: str, schema: T.StructType, keys: tuple[str, ...] = (), folder: str | None = None
) -> None:
    """Make a written folder visible as ``database.table``, and let the catalog follow its columns.

    Columns that the catalog does not know are added; rows from before have
    NULL there. ``folder``: the partition that was written, if only that is
    new. A table of that name at another place gives way; its files stay.
    """
    name = f"`{database}`.`{table}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    if table_exists(spark, database, table):
        place = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()
        if place is None or place["data_type"].split(":")[-1].rstrip("/") != path.split(":")[-1].rstrip("/"):
            spark.sql(f"DROP TABLE {name}")
    if not table_exists(spark, database, table):
        kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in keys] + [f"`{k}` INT" for k in keys]
        parted = f"PARTITIONED BY ({', '.join(keys)})" if keys else ""
        spark.sql(f"CREATE TABLE {name} ({', '.join(kinds)}) USING parquet {parted} LOCATION '{path}'")
        found = [f"{path}/{part}" for part in Files(spark, path).folders_below(path, len(keys))] if keys else []
    else:
        known = {c.name.lower() for c in spark.catalog.listColumns(f"{database}.{table}")}
        new = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name.lower() not in known]
        if new:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")
        found = [folder] if folder else []
    for low in range(0, len(found), PARTITIONS_AT_ONCE):
        # Months and days have a leading zero in folder names, not in the catalog.
        values = [(f, ", ".join(f"{p.split('=')[0]} = {int(p.split('=')[1])}" for p in f.split("/")[-len(keys) :])) for f in found[low : low + PARTITIONS_AT_ONCE]]
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({v}) LOCATION '{f}'" for f, v in values))
    spark.catalog.refreshTable(f"{database}.{table}")


def replace_view(spark: SparkSession, database: str, name: str, target: str) -> None:
    """Let ``database.name`` show the table ``target`` of the same database, by one catalog call.

    A plain table of that name, from before tables had versions, gives way to
    the view; its files stay.
    """
    if table_exists(spark, database, name) and spark.catalog.getTable(f"{database}.{name}").tableType != "VIEW":
        spark.sql(f"DROP TABLE `{database}`.`{name}`")
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT * FROM `{database}`.`{target}`")


def register_views(frames: dict[str, DataFrame], prefix: str = "") -> None:
    """Temporary views for ad-hoc SQL over any mix of layers."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
