"""What tables and columns a lake folder holds, against what is declared."""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.schemas import TEXT, struct
from granary.session import configure

REPORT_SCHEMA = struct(("tabela", TEXT), ("coluna", TEXT), ("tipo", TEXT), ("situacao", TEXT))


def find_tables(spark: SparkSession, root: str) -> list[str]:
    """Names directly below ``root`` that hold Parquet files.

    Uses the file listing only. Success markers, temporary folders and report
    folders start with an underscore, and Spark lists none of those.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
    )
    # The listing may spell the root in full; the part after its last name is what counts.
    tail = root.rstrip("/").rsplit("/", 1)[-1]
    name = F.element_at(F.split(F.substring_index("path", f"/{tail}/", -1), "/"), 1)
    return sorted(row[0] for row in files.select(name).distinct().collect())


def discover_schema(
    spark: SparkSession, root: str, declared: Mapping[str, T.StructType]
) -> DataFrame:
    """One row per table and column: ``declared``, ``retyped``, ``added`` or ``removed``.

    New columns of any file are merged in; a table whose files cannot be
    merged gets one row ``conflict``.
    """
    configure(spark)
    rows: list[tuple[str, str, str, str]] = []
    for entry in find_tables(spark, root):
        table = entry.removesuffix(".parquet")
        try:
            found = spark.read.option("mergeSchema", "true").parquet(f"{root}/{entry}").schema
        except (PySparkException, Py4JJavaError) as error:
            cause = error.java_exception.getMessage() if isinstance(error, Py4JJavaError) else str(error)
            rows.append((table, "*", cause.splitlines()[0], "conflict"))
            continue
        rows += _compare(table, found, declared.get(table))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def _compare(table: str, found: T.StructType, wanted: T.StructType | None):
    types = {f.name: f.dataType.simpleString() for f in (wanted.fields if wanted else [])}
    for f in found.fields:
        kind = f.dataType.simpleString()
        if f.name not in types:
            yield table, f.name, kind, "added"
        else:
            yield table, f.name, kind, "declared" if kind == types[f.name] else "retyped"
    present = set(found.fieldNames())
    for name, kind in types.items():
        if name not in present:
            yield table, name, kind, "removed"
