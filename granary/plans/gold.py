"""Gold tables.

Two meanings of "sales" exist side by side. The plain tables work at line
grain: a sale with three lines counts three times and its total is added three
times. The ``*_by_order`` tables take the fact at sale grain and count each sale
once; the ``*_by_subtotal`` tables add the line's own subtotal.

Each table is built in two steps. ``*_totals`` reduces the fact to one row per
day, product or customer; a key that holds a third of the fact is combined
inside each task. The tables add those rows up further, and only they meet the
dimensions. A job stores the totals once and builds several tables from them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.money import is_exact, rounded_mean, rounded_total

# Limits of the ranked tables.
TOP_PRODUCTS = 100
TOP_CUSTOMERS = 500
VIP_SPEND = 1000
# End of fixed values.


def recent_period(facts: DataFrame, today: dt.date) -> DataFrame:
    """Rows of the incremental gold run: this year and the one before, by partition column only."""
    return facts.filter(F.col("ano") >= today.year - 1)


def measures(value: str, price: str | None = None) -> list[Column]:
    """Sums and counts that can be added up again."""
    columns = [
        F.count("*").alias("_rows"),
        F.sum(value).alias("_value"),
        F.count(value).alias("_value_rows"),
        F.sum("quantidade").alias("_items"),
        F.count("dim_cliente_id").alias("_customers"),
    ]
    if price:
        columns += [F.sum(price).alias("_price"), F.count(price).alias("_price_rows")]
    return columns


def _added(*names: str) -> list[Column]:
    return [F.sum(f"_{n}").alias(f"_{n}") for n in names]


def _mean(totals: DataFrame, value: str = "value") -> Column:
    name = f"_{value}"
    return rounded_mean(F.col(name), F.col(f"{name}_rows"), is_exact(totals, name))


def span() -> list[Column]:
    return [F.max("data_venda").alias("_last"), F.min("data_venda").alias("_first")]


# --- totals -------------------------------------------------------------------


def day_totals(facts: DataFrame) -> DataFrame:
    return facts.groupBy("dim_tempo_data", "ano", "mes").agg(*measures("total_venda"), *span())


def product_totals(facts: DataFrame, value: str = "total_venda") -> DataFrame:
    return facts.groupBy(F.col("dim_produto_id").alias("produto_id")).agg(
        *measures(value, "preco_unitario")
    )


def customer_totals(facts: DataFrame) -> DataFrame:
    return facts.groupBy(F.col("dim_cliente_id").alias("cliente_id")).agg(
        *measures("total_venda"), *span()
    )


def added_up(totals: DataFrame, *keys: str) -> DataFrame:
    """Totals of finer keys, per ``keys``."""
    names = [c[1:] for c in totals.columns if c.startswith("_") and c not in ("_last", "_first")]
    return totals.groupBy(*keys).agg(*_added(*names), F.max("_last").alias("_last"), F.min("_first").alias("_first"))


# --- tables from totals ---------------------------------------------------------


def monthly_from_days(days: DataFrame) -> DataFrame:
    return (
        days.groupBy("ano", "mes")
        .agg(*_added("rows", "value", "value_rows", "items", "customers"))
        .select(
            "ano",
            "mes",
            F.col("_rows").alias("total_vendas"),
            rounded_total(F.col("_value")).alias("receita_total"),
            F.col("_items").alias("itens_vendidos"),
            _mean(days).alias("ticket_medio"),
            F.col("_customers").alias("clientes_unicos"),
        )
    )


def daily_from_days(days: DataFrame, calendar: DataFrame) -> DataFrame:
    attributes = ["data", "ano", "mes", "dia", "dia_semana_nome", "tipo_dia"]
    return (
        days.drop("ano", "mes")
        .withColumnRenamed("dim_tempo_data", "data")
        .join(calendar.select(*attributes), "data")
        .groupBy(*attributes)
        .agg(*_added("rows", "value", "value_rows", "items"))
        .select(
            *attributes,
            F.col("_rows").alias("vendas_dia"),
            rounded_total(F.col("_value")).alias("receita_dia"),
            F.col("_items").alias("itens_dia"),
            _mean(days).alias("ticket_medio_dia"),
        )
    )


def _summary(totals: DataFrame, buyers: Column, period: str) -> DataFrame:
    return totals.select(
        F.coalesce("_rows", F.lit(0)).alias("total_transacoes"),
        rounded_total(F.col("_value")).alias("receita_total_periodo"),
        F.col("_items").alias("total_itens_vendidos"),
        _mean(totals).alias("ticket_medio_geral"),
        F.coalesce(buyers, F.lit(0)).alias("total_clientes"),
        F.col("_last").alias("data_ultima_venda"),
        F.col("_first").alias("data_primeira_venda"),
        F.lit(period).alias("periodo_analise"),
    )


def summary_from_days(days: DataFrame, period: str) -> DataFrame:
    """Always one row; zero counts and NULL sums when there are no facts."""
    everything = days.agg(
        *_added("rows", "value", "value_rows", "items", "customers"),
        F.max("_last").alias("_last"),
        F.min("_first").alias("_first"),
    )
    return _summary(everything, F.col("_customers"), period)


def top_from_products(
    totals: DataFrame, products: DataFrame, categories: DataFrame, limit: int = TOP_PRODUCTS
) -> DataFrame:
    """Best sellers by revenue. Products whose category is unknown drop out."""
    order = ("produto_id", "produto_nome", "categoria_nome")
    return (
        totals.join(products.select("produto_id", "produto_nome", "categoria_id"), "produto_id")
        .join(categories.select("categoria_id", "categoria_nome"), "categoria_id")
        .groupBy(*order)
        .agg(*_added("items", "value", "rows", "price", "price_rows"))
        .select(
            *order,
            F.col("_items").alias("quantidade_vendida"),
            rounded_total(F.col("_value")).alias("receita_produto"),
            F.col("_rows").alias("numero_vendas"),
            _mean(totals, "price").alias("preco_medio"),
        )
        .orderBy(F.desc("receita_produto"), *order)
        .limit(limit)
    )


def _category_columns(totals: DataFrame, buyers: str) -> list[Column]:
    return [
        F.col("categoria_id"),
        F.col("categoria_nome"),
        rounded_total(F.col("_value")).alias("receita_categoria"),
        F.col("_items").alias("itens_vendidos"),
        F.col("_rows").alias("numero_transacoes"),
        _mean(totals, "price").alias("preco_medio_categoria"),
        F.col(buyers).alias("clientes_unicos"),
    ]


def categories_from_products(
    totals: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    """Totals per category. Only when they are added up do they get the category's name,
    so a category with most of the products meets it as one row.
    """
    names = ("value", "items", "rows", "price", "price_rows", "customers")
    per_category = (
        totals.join(products.select("produto_id", "categoria_id"), "produto_id")
        .groupBy("categoria_id")
        .agg(*_added(*names))
    )
    named = (
        per_category.join(categories.select("categoria_id", "categoria_nome"), "categoria_id")
        .groupBy("categoria_id", "categoria_nome")
        .agg(*_added(*names))
    )
    return named.select(*_category_columns(named, "_customers"))


def vip_from_customers(
    totals: DataFrame,
    customers: DataFrame,
    limit: int = TOP_CUSTOMERS,
    minimum: float = VIP_SPEND,
) -> DataFrame:
    """Customers whose rounded spend is above ``minimum``, biggest first."""
    names = ("cliente_id", "cliente_nome_completo", "cliente_email")
    return (
        totals.join(customers.select(*names), "cliente_id")
        .groupBy(*names)
        .agg(
            *_added("value", "rows", "value_rows"),
            F.max("_last").alias("ultima_compra"),
            F.min("_first").alias("primeira_compra"),
        )
        .select(
            *names,
            rounded_total(F.col("_value")).alias("valor_total_compras"),
            F.col("_rows").alias("numero_compras"),
            _mean(totals).alias("ticket_medio_cliente"),
            "ultima_compra",
            "primeira_compra",
        )
        .filter(F.col("valor_total_compras") > minimum)
        .orderBy(F.desc("valor_total_compras"), *names)
        .limit(limit)
    )


# --- tables straight from the fact ----------------------------------------------


def monthly_sales(facts: DataFrame) -> DataFrame:
    return monthly_from_days(day_totals(facts))


def daily_sales(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    return daily_from_days(day_totals(facts), calendar)


def executive_summary(facts: DataFrame, period: str) -> DataFrame:
    return summary_from_days(day_totals(facts), period)


def top_products(
    facts: DataFrame, products: DataFrame, categories: DataFrame, limit: int = TOP_PRODUCTS
) -> DataFrame:
    return top_from_products(product_totals(facts), products, categories, limit)


def category_performance(facts: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    return categories_from_products(product_totals(facts), products, categories)


def vip_customers(
    facts: DataFrame, customers: DataFrame, limit: int = TOP_CUSTOMERS, minimum: float = VIP_SPEND
) -> DataFrame:
    return vip_from_customers(customer_totals(facts), customers, limit, minimum)


# --- lines by their own subtotal --------------------------------------------------


def top_products_by_subtotal(
    facts: DataFrame, products: DataFrame, categories: DataFrame, limit: int = TOP_PRODUCTS
) -> DataFrame:
    return top_from_products(product_totals(facts, "subtotal"), products, categories, limit)


def category_performance_by_subtotal(
    facts: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    """Category revenue from the lines' own subtotals, with real distinct customers.

    Distinct customers cannot be added up from products, so here the lines are
    joined, once for all measures. A hot product's lines are split by adaptive
    execution, and (category, customer) pairs are combined before they move on.
    """
    kinds = products.select("produto_id", "categoria_id").join(
        categories.select("categoria_id", "categoria_nome"), "categoria_id"
    )
    summed = (
        facts.withColumnRenamed("dim_produto_id", "produto_id")
        .join(kinds, "produto_id")
        .groupBy("categoria_id", "categoria_nome")
        .agg(
            *measures("subtotal", "preco_unitario"),
            F.count_distinct("dim_cliente_id").alias("_buyers"),
        )
    )
    return summed.select(*_category_columns(summed, "_buyers"))


# --- each sale counted once: ``sales`` is the fact at sale grain -------------------


def monthly_sales_by_order(sales: DataFrame, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    summed = sales.groupBy("ano", "mes").agg(
        *measures("total_venda"), distinct("dim_cliente_id").alias("clientes_unicos")
    )
    return summed.select(
        "ano",
        "mes",
        F.col("_rows").alias("total_vendas"),
        rounded_total(F.col("_value")).alias("receita_total"),
        F.col("_items").alias("itens_vendidos"),
        _mean(summed).alias("ticket_medio"),
        "clientes_unicos",
    )


def vip_customers_by_order(
    sales: DataFrame, customers: DataFrame, limit: int = TOP_CUSTOMERS, minimum: float = VIP_SPEND
) -> DataFrame:
    return vip_customers(sales, customers, limit, minimum)


def daily_sales_by_order(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    return daily_sales(sales, calendar)


def executive_summary_by_order(sales: DataFrame, period: str) -> DataFrame:
    summed = sales.agg(
        *measures("total_venda"), *span(), F.count_distinct("dim_cliente_id").alias("_buyers")
    )
    return _summary(summed, F.col("_buyers"), period)


# Order in which a reader sees the tables. They are written unsorted: a sort
# before a partitioned write is a shuffle whose order the files do not keep.
PRESENTATION = {
    "vendas_mensais": {"ano": True, "mes": True},
    "performance_categorias": {"receita_categoria": False, "categoria_id": True},
    "vendas_diarias": {"data": False},
}


def presented(table: DataFrame, name: str) -> DataFrame:
    order = PRESENTATION[name]
    return table.orderBy(*order, ascending=list(order.values()))
