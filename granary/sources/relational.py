"""Extraction from relational tables, in full or for one date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.scalars import literal_like


@dataclass(frozen=True)
class SourceTable:
    """How a table is extracted.

    ``updated_column`` names a last-change column where the source has one, so
    that changed rows are extracted again and not only new ones.
    """

    name: str
    date_column: str | None
    incremental: bool
    updated_column: str | None = None
    key: str = "id"

    @property
    def kind(self) -> str:
        return "incremental" if self.incremental else "full"


# The source tables, their date columns and load kinds.
SOURCE_TABLES = (
    SourceTable("vendas", "data_venda", True, "atualizado_em"),
    SourceTable("produtos", "criado_em", True, "atualizado_em"),
    SourceTable("itens_venda", None, False),
    SourceTable("clientes", "criado_em", True, "atualizado_em"),
    SourceTable("categorias", "criado_em", True, "atualizado_em"),
    SourceTable("fornecedores", "criado_em", True, "atualizado_em"),
    SourceTable("enderecos", "criado_em", True, "atualizado_em"),
)
# End of fixed values.


@dataclass(frozen=True)
class Endpoint:
    """A database address. Credentials come from the caller and are never stored here."""

    url: str
    options: Mapping[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000


def _reader(spark: SparkSession, endpoint: Endpoint):
    return (
        spark.read.format("jdbc")
        .option("url", endpoint.url)
        .option("fetchsize", endpoint.fetch_size)
        .options(**endpoint.options)
    )


def key_range_query(table: SourceTable) -> str:
    return f"SELECT MIN({table.key}) AS low, MAX({table.key}) AS high FROM {table.name}"


def page_options(table: SourceTable, low: int | None, high: int | None, pages: int) -> dict[str, str]:
    """Reader options that split a table by key range; none for an empty table or one page."""
    if pages <= 1 or low is None or high is None or low == high:
        return {}
    return {
        "partitionColumn": table.key,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(min(pages, high - low + 1)),
    }


def extract_full(spark: SparkSession, endpoint: Endpoint, table: SourceTable, pages: int = 1) -> DataFrame:
    """The whole table, read by ``pages`` tasks over ranges of its key."""
    options = {}
    if pages > 1:
        bounds = _reader(spark, endpoint).option("query", key_range_query(table)).load().first()
        options = page_options(table, bounds[0], bounds[1], pages)
    return _reader(spark, endpoint).option("dbtable", table.name).options(**options).load()


def extract_for_date(
    spark: SparkSession, endpoint: Endpoint, table: SourceTable, day: dt.date, pages: int = 1
) -> DataFrame:
    return changed_on(extract_full(spark, endpoint, table, pages), table, day)


def changed_on(frame: DataFrame, table: SourceTable, day: dt.date) -> DataFrame:
    """Rows created or updated on ``day``; every row if the table is not incremental.

    A half-open range on the bare column: unlike a function around the column
    it is pushed to the database or to the file statistics.
    """
    if not table.incremental or table.date_column is None:
        return frame
    columns = [table.date_column]
    if table.updated_column and table.updated_column in frame.columns:
        columns.append(table.updated_column)
    condition = _within(frame, columns[0], day)
    for column in columns[1:]:
        condition = condition | _within(frame, column, day)
    return frame.filter(condition)


def _within(frame: DataFrame, column: str, day: dt.date) -> Column:
    kind = frame.schema[column].dataType
    start, end = literal_like(day, kind), literal_like(day + dt.timedelta(days=1), kind)
    return (F.col(column) >= start) & (F.col(column) < end)
