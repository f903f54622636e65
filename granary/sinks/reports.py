"""Run reports and the manifest of written files."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.schemas import PARTITION_KEYS, REPORTS
from granary.sinks.lake import COMPRESSION, WriteResult

_SECONDS = "%Y-%m-%d %H:%M:%S"


def stamp(moment: dt.datetime | None) -> str | None:
    return moment.strftime(_SECONDS) if moment else None


def silver_report(
    spark: SparkSession,
    execution_date: str,
    triggered_by: str,
    incremental: bool,
    totals: dict,
    latest_sale: dt.datetime | None,
    now: dt.datetime,
) -> DataFrame:
    """One row about a silver run; totals that are NULL count as zero."""
    row = (
        execution_date,
        triggered_by,
        incremental,
        int(totals.get("total_records") or 0),
        float(totals.get("total_value") or 0.0),
        int(totals.get("total_items") or 0),
        stamp(latest_sale),
        stamp(now),
    )
    return spark.createDataFrame([row], REPORTS["_execution_reports"])


def gold_report(
    spark: SparkSession,
    execution_date: str,
    triggered_by: str,
    incremental: bool,
    gold_rows: int,
    fact_rows: int,
    now: dt.datetime,
) -> DataFrame:
    row = (execution_date, triggered_by, incremental, gold_rows, fact_rows, stamp(now))
    return spark.createDataFrame([row], REPORTS["_gold_execution_reports"])


def save_report(report: DataFrame, root: str, table: str) -> str:
    """Replace the report of the same execution date; keep those of other dates."""
    path = f"{root}/{table}"
    (
        report.coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_KEYS[table])
        .parquet(path)
    )
    return path


def extract_report(spark: SparkSession, outcomes: Sequence[tuple]) -> DataFrame:
    """One row per table of an extraction run."""
    return spark.createDataFrame(list(outcomes), REPORTS["_extract_report"])


def extract_summary(report: DataFrame, run: str, moment: dt.datetime) -> DataFrame:
    """The run as one nested row, ready for ``write.json``.

    An empty extract is reported as ``no_data``; a failed one lists no date.
    The report has one row per source table, so collecting it into a map is
    bounded by the table registry.
    """
    succeeded = F.col("situacao") == "success"
    failed = F.col("situacao") == "error"
    entry = F.struct(
        F.col("registros").alias("records"),
        F.when(F.col("situacao") == "empty", F.lit("no_data")).otherwise(F.col("situacao")).alias("status"),
        F.when(failed, F.array().cast("array<string>")).otherwise(F.array("data_extracao")).alias("dates_processed"),
        F.lit("parquet").alias("format"),
    )
    pairs = F.sort_array(F.collect_list(F.struct(F.col("tabela"), entry)))
    return report.agg(
        F.lit(run).alias("run"),
        F.max("data_extracao").alias("execution_date"),
        F.lit(moment.isoformat()).alias("execution_timestamp"),
        F.when(F.max(failed), F.lit("failed")).otherwise(F.lit("completed")).alias("status"),
        F.lit("parquet").alias("format"),
        F.count(F.lit(1)).alias("total_tables"),
        F.count_if(succeeded).alias("successful_extractions"),
        F.sum("registros").alias("total_records"),
        F.map_from_entries(pairs).alias("tables"),
    )


def save_extract_summary(summary: DataFrame, root: str) -> str:
    day = summary.select("execution_date").first()[0]
    path = f"{root}/_reports/extraction_report_{day}"
    summary.coalesce(1).write.mode("overwrite").json(path)
    return path


def manifest(
    spark: SparkSession, results: Sequence[WriteResult], execution_date: str, kinds: dict[str, str]
) -> DataFrame:
    """One row per write with file count and size, from the listing of each folder."""
    rows = []
    for result in results:
        files, size = 0, 0
        if result.rows:
            listed = (
                spark.read.format("binaryFile")
                .option("recursiveFileLookup", "true")
                .option("pathGlobFilter", "*.parquet")
                .load(result.folder or result.path)
            )
            files, size = listed.agg(F.count(F.lit(1)), F.sum("length")).first()
        rows.append(
            (
                execution_date, result.table, result.folder or result.path, result.rows,
                kinds.get(result.table, "full"), "parquet", COMPRESSION, files,
                round((size or 0) / (1024 * 1024), 2),
            )
        )
    return spark.createDataFrame(rows, REPORTS["_manifest"])


def as_json_text(summary: DataFrame) -> str:
    return json.dumps(json.loads(summary.toJSON().first()), ensure_ascii=False, indent=2)
