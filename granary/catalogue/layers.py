"""Silver and gold tables as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame

from granary.catalogue.base import AS_OF, calendar, categories, customers, facts, products, query, sales
from granary.plans import gold, silver
from granary.sources.testbed import Testbed

# --- silver -------------------------------------------------------------------


@query
def dim_suppliers(bed: Testbed) -> DataFrame:
    return silver.dim_suppliers(bed.fornecedores())


@query
def dim_categories(bed: Testbed) -> DataFrame:
    return categories(bed)


@query
def dim_products(bed: Testbed) -> DataFrame:
    return products(bed)


@query
def dim_customers(bed: Testbed) -> DataFrame:
    return customers(bed)


@query
def dim_addresses(bed: Testbed) -> DataFrame:
    return silver.dim_addresses(bed.enderecos())


@query
def dim_date(bed: Testbed) -> DataFrame:
    return silver.dim_date(bed.vendas(), with_iso_year=True)


@query
def facts_sales(bed: Testbed) -> DataFrame:
    return facts(bed).drop("data_envio", "desconto", "imposto")


@query
def rejected_lines(bed: Testbed) -> DataFrame:
    return silver.rejection_report(bed.vendas(), bed.itens_venda())


@query
def silver_run_totals(bed: Testbed) -> DataFrame:
    return silver.run_totals(facts(bed))


# --- gold ---------------------------------------------------------------------


@query
def monthly_sales(bed: Testbed) -> DataFrame:
    return gold.presented(gold.monthly_sales(facts(bed)), "vendas_mensais")


@query
def top_products(bed: Testbed) -> DataFrame:
    return gold.top_products(facts(bed), products(bed), categories(bed))


@query
def vip_customers(bed: Testbed) -> DataFrame:
    return gold.vip_customers(facts(bed), customers(bed))


@query
def category_performance(bed: Testbed) -> DataFrame:
    table = gold.category_performance(facts(bed), products(bed), categories(bed))
    return gold.presented(table, "performance_categorias")


@query
def daily_sales(bed: Testbed) -> DataFrame:
    return gold.presented(gold.daily_sales(facts(bed), calendar(bed)), "vendas_diarias")


@query
def executive_summary(bed: Testbed) -> DataFrame:
    return gold.executive_summary(facts(bed), AS_OF.isoformat())


@query
def monthly_sales_by_order(bed: Testbed) -> DataFrame:
    return gold.presented(gold.monthly_sales_by_order(sales(bed)), "vendas_mensais")


@query
def vip_customers_by_order(bed: Testbed) -> DataFrame:
    return gold.vip_customers_by_order(sales(bed), customers(bed))


@query
def daily_sales_by_order(bed: Testbed) -> DataFrame:
    return gold.presented(gold.daily_sales_by_order(sales(bed), calendar(bed)), "vendas_diarias")


@query
def top_products_by_subtotal(bed: Testbed) -> DataFrame:
    return gold.top_products_by_subtotal(facts(bed), products(bed), categories(bed))


@query
def category_performance_by_subtotal(bed: Testbed) -> DataFrame:
    table = gold.category_performance_by_subtotal(facts(bed), products(bed), categories(bed))
    return gold.presented(table, "performance_categorias")


@query
def executive_summary_by_order(bed: Testbed) -> DataFrame:
    return gold.executive_summary_by_order(sales(bed), AS_OF.isoformat())
