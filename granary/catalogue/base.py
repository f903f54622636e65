"""The registry and the frames that most queries start from."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from granary.functions.money import plain_numbers
from granary.plans import silver
from granary.session import configure
from granary.sources.testbed import Testbed

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2001, 12, 31)

QUERIES: dict[str, Query] = {}


def query(build: Callable[[Testbed], DataFrame]) -> Callable[[Testbed], DataFrame]:
    """Register a builder under its own name; decimals leave as doubles."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain_numbers(build(Testbed(configure(spark), folder)))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


def facts(bed: Testbed) -> DataFrame:
    return silver.facts_sales(bed.vendas(), bed.itens_venda())


def sales(bed: Testbed) -> DataFrame:
    return silver.sales_with_lines(bed.vendas(), bed.itens_venda())


def products(bed: Testbed) -> DataFrame:
    return silver.dim_products(bed.produtos(), bed.categorias(), bed.fornecedores())


def categories(bed: Testbed) -> DataFrame:
    return silver.dim_categories(bed.categorias())


def customers(bed: Testbed) -> DataFrame:
    return silver.dim_customers(bed.clientes(), AS_OF)


def calendar(bed: Testbed) -> DataFrame:
    return silver.dim_date(bed.vendas())
