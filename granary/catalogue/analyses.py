"""Analyses as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.catalogue.base import AS_OF, calendar, facts, products, query, sales
from granary.plans import silver
from granary.plans.analyses import customers, operations
from granary.plans.analyses import products as product_plans
from granary.plans.analyses import sales as sales_plans
from granary.sources.testbed import Testbed

SILVER_FROM, GOLD_FROM = 1_500_000, 3_000_000
STATUSES = ("F", "O", "P")


@query
def customer_category(bed: Testbed) -> DataFrame:
    return customers.customer_category(customers.customer_sales(sales(bed)), SILVER_FROM, GOLD_FROM)


@query
def sales_by_period(bed: Testbed) -> DataFrame:
    return sales_plans.sales_by_period(sales_plans.day_sales(sales(bed)))


@query
def ticket_by_customer(bed: Testbed) -> DataFrame:
    return customers.ticket_by_customer(customers.customer_sales(sales(bed)))


@query
def ticket_by_category(bed: Testbed) -> DataFrame:
    return product_plans.ticket_by_category(product_plans.category_sales(facts(bed), products(bed)))


@query
def conversion_daily(bed: Testbed) -> DataFrame:
    return sales_plans.conversion_daily(bed.raw("events"), "ts", "user_id", "event_type")


@query
def seasonality(bed: Testbed) -> DataFrame:
    return sales_plans.seasonality(sales_plans.month_sales(sales(bed)))


@query
def sales_trend(bed: Testbed) -> DataFrame:
    return sales_plans.sales_trend(sales_plans.month_sales(sales(bed)))


@query
def rfm_segments(bed: Testbed) -> DataFrame:
    return customers.rfm_segments(customers.customer_sales(sales(bed)), AS_OF)


@query
def customer_ltv(bed: Testbed) -> DataFrame:
    return customers.customer_ltv(customers.customer_sales(sales(bed)))


@query
def sales_by_segment(bed: Testbed) -> DataFrame:
    """By market segment, region, gender and age band."""
    people = silver.dim_customers(bed.clientes(), AS_OF)
    segments = bed.clientes().select(F.col("id").alias("cliente_id"), "segmento")
    places = customers.main_address(silver.dim_addresses(bed.enderecos())).select("cliente_id", F.col("endereco_estado").alias("regiao"))
    described = (
        people.join(segments, "cliente_id")
        .join(places, "cliente_id")
        .select(
            "cliente_id",
            "segmento",
            "regiao",
            F.col("cliente_genero").alias("genero"),
            customers.age_band(F.col("cliente_idade")).alias("faixa_etaria"),
        )
    )
    return customers.sales_by_segment(
        customers.customer_sales(sales(bed)), described, ["segmento", "regiao", "genero", "faixa_etaria"]
    )


@query
def rank_in_category(bed: Testbed) -> DataFrame:
    return product_plans.rank_in_category(product_plans.product_sales(facts(bed)), products(bed))


@query
def margin_by_category(bed: Testbed) -> DataFrame:
    return product_plans.margin_by_category(product_plans.product_sales(facts(bed)), products(bed))


@query
def stock_turnover(bed: Testbed) -> DataFrame:
    return product_plans.stock_turnover(product_plans.product_sales(facts(bed)), products(bed), calendar(bed))


@query
def supplier_metrics(bed: Testbed) -> DataFrame:
    return product_plans.supplier_metrics(product_plans.product_sales(facts(bed)), products(bed))


@query
def regional_rollup(bed: Testbed) -> DataFrame:
    return operations.regional_rollup(operations.address_sales(sales(bed)), silver.dim_addresses(bed.enderecos()))


@query
def shipping_days(bed: Testbed) -> DataFrame:
    return operations.shipping_days(operations.shipping_histogram(facts(bed), "ano"), operations.yearly_freight(facts(bed)))


@query
def financials(bed: Testbed) -> DataFrame:
    return sales_plans.financials(sales_plans.month_amounts(facts(bed)))


@query
def payment_status_pivot(bed: Testbed) -> DataFrame:
    return sales_plans.payment_status_pivot(sales_plans.month_sales(sales(bed)), STATUSES)
