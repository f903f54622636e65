"""Stored totals that all analyses of sales are added up from.

Four tables lie between the fact and the analyses. Each is built from the fact
in one pass, in the fact's partitions, and kept up as ``totals.bring_up`` says,
so an incremental run reads the touched days of the fact once per table, and
moves none of its lines:

- ``sales``: day, customer, address and payment status; a sale counts once
- ``lines``: day and product; a line counts once, by its own amounts
- ``kinds``: day and category; distinct sales. All lines of a sale lie in one
  day, so days add up to whole counts. Categories come from the products, so
  this table notes a digest of them and is built anew when one has moved
- ``shipped``: day and days to shipment

Discount, tax and shipment are columns that a source may lack; what needs them
is then absent.
"""

from __future__ import annotations

import datetime as dt
import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators.members import Values
from granary.plans import silver
from granary.plans.analyses import operations, products, sales
from granary.plans.totals import DAY, bring_up
from granary.sinks.versions import VersionedTable

RATES = ("desconto", "imposto")
SHIPPED = "data_envio"


def sale_days(facts: DataFrame) -> DataFrame:
    """Sales are put together from their lines inside their day, so that no row depends on another partition of the fact."""
    whole = silver.sales_from_facts(facts, *DAY)
    keys = {"dim_cliente_id": "cliente_id", "dim_endereco_id": "endereco_id", "status_pagamento": "status_pagamento"}
    return whole.groupBy(*DAY, *[F.col(c).alias(n) for c, n in keys.items()]).agg(
        F.count("*").alias("vendas"),
        F.sum("total_venda").alias("receita"),
        F.sum("frete").alias("frete"),
        F.sum("quantidade").alias("itens"),
        F.min("data_venda").alias("primeira_venda"),
        F.max("data_venda").alias("ultima_venda"),
    )


def line_days(facts: DataFrame) -> DataFrame:
    more = sales.amounts() if set(RATES) <= set(facts.columns) else []
    return facts.groupBy(*DAY, F.col("dim_produto_id").alias("produto_id")).agg(*products.line_sums(), *more)


def kind_days(facts: DataFrame, kinds: Values) -> DataFrame:
    """By category id only, so that a category may change its name. ``kinds`` has the products' categories."""
    return products.category_sums(kinds.joined(facts, "dim_produto_id", "categoria_id"), *DAY, "categoria_id")


def digest(goods: DataFrame) -> str:
    """Count and hash sum of (product, category), whatever the order; NULLs are marked."""
    pair = F.xxhash64("produto_id", F.coalesce(F.col("categoria_id"), F.lit(0)), F.col("categoria_id").isNull())
    row = goods.agg(F.count("*").alias("n"), F.sum(pair.cast("decimal(20,0)")).alias("h")).first()
    return f"{row['n']}:{row['h']}"


@dataclass(frozen=True)
class Lattice:
    """The stored tables at one version of the fact, and the reductions that the analyses take."""

    sales: DataFrame
    lines: DataFrame
    kinds: DataFrame
    shipped: DataFrame | None

    def _of_sales(self, *keys: str | Column, more: tuple[Column, ...] = ()) -> DataFrame:
        return self.sales.groupBy(*keys).agg(F.sum("vendas").alias("vendas"), F.sum("receita").alias("receita"), *more)

    def buyers(self) -> DataFrame:
        ends = (F.min("primeira_venda").alias("primeira_venda"), F.max("ultima_venda").alias("ultima_venda"))
        return self._of_sales("cliente_id", more=ends)

    def days(self) -> DataFrame:
        return self._of_sales(F.col("dim_tempo_data").alias("dia"), more=(F.sum("itens").alias("itens"),))

    def months(self) -> DataFrame:
        return self._of_sales("ano", "mes", "status_pagamento").drop("vendas")

    def addresses(self) -> DataFrame:
        return self._of_sales("endereco_id")

    def freight(self) -> DataFrame:
        return self._of_sales("ano", more=(F.sum("frete").alias("frete"),)).drop("vendas")

    def products(self) -> DataFrame:
        sums = ("quantidade", "receita", "valor_vendido", "linhas")
        return self.lines.groupBy("produto_id").agg(*[F.sum(c).alias(c) for c in sums])

    def categories(self, goods: DataFrame) -> DataFrame:
        """Per category as the products name it; one that has two names counts once for each, with the sales of both."""
        names = goods.select("categoria_id", "categoria_nome").distinct()
        summed = self.kinds.groupBy("categoria_id").agg(F.sum("vendas").alias("vendas"), F.sum("receita").alias("receita"))
        return summed.alias("s").join(names.alias("n"), F.col("s.categoria_id").eqNullSafe(F.col("n.categoria_id"))).select(
            "n.categoria_id", "n.categoria_nome", "s.vendas", "s.receita"
        )

    def amounts(self) -> DataFrame | None:
        sums = ("_gross", "_discount", "_tax")
        if not set(sums) <= set(self.lines.columns):
            return None
        return self.lines.groupBy("ano", "mes").agg(*[F.sum(c).alias(c) for c in sums])

    def shipping(self) -> DataFrame | None:
        if self.shipped is None:
            return None
        return self.shipped.groupBy("ano", "dias").agg(F.sum("linhas").alias("linhas"))


def refresh(
    spark: SparkSession, gold_root: str, facts: VersionedTable, goods: DataFrame, at: dt.datetime, incremental: bool
) -> Lattice:
    """Bring the tables up to the fact's newest version. ``goods`` are the products, with their categories."""
    bring = functools.partial(bring_up, spark, f"{gold_root}/_lattice", facts, at, incremental)
    version = facts.current()
    kinds = Values.of(goods.select("produto_id", "categoria_id"))
    has_shipments = version is not None and SHIPPED in version.schema.names
    return Lattice(
        bring("sales", sale_days),
        bring("lines", line_days),
        bring("kinds", lambda rows: kind_days(rows, kinds), depends=digest(goods), in_place=kinds.words is not None),
        bring("shipped", lambda rows: operations.shipping_histogram(rows, *DAY)) if has_shipments else None,
    )
