"""The analyses as tables, by name, from the stored totals of ``lattice``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.plans.analyses import customers, operations, products, sales
from granary.plans.lattice import Lattice


@dataclass(frozen=True)
class Limits:
    """What the analyses leave open. ``statuses``: payment statuses that get a column of their own."""

    silver_from: float = 1_000
    gold_from: float = 5_000
    horizon_months: int = 12
    top: int = 10
    statuses: Sequence[str] = ("aprovado", "pendente", "recusado")


@dataclass(frozen=True)
class Dimensions:
    products: DataFrame
    customers: DataFrame
    addresses: DataFrame
    calendar: DataFrame


def people(of: Dimensions) -> DataFrame:
    """The attributes that sales are grouped by; customers without an address have no region."""
    places = customers.main_address(of.addresses).select("cliente_id", F.col("endereco_estado").alias("regiao"))
    gender, band = F.col("cliente_genero").alias("genero"), customers.age_band(F.col("cliente_idade")).alias("faixa_etaria")
    return of.customers.join(places, "cliente_id", "left").select("cliente_id", "regiao", gender, band)


def tables(stored: Lattice, of: Dimensions, as_of: dt.date, limits: Limits = Limits()) -> dict[str, Callable[[], DataFrame]]:
    """How to build each table. None reads the fact; those whose source columns the fact lacks are left out."""
    found = {
        "categoria_clientes": lambda: customers.customer_category(stored.buyers(), limits.silver_from, limits.gold_from),
        "ticket_clientes": lambda: customers.ticket_by_customer(stored.buyers()),
        "valor_vida_clientes": lambda: customers.customer_ltv(stored.buyers(), limits.horizon_months),
        "segmentos_rfm": lambda: customers.rfm_segments(stored.buyers(), as_of),
        "vendas_por_segmento": lambda: customers.sales_by_segment(stored.buyers(), people(of), ["regiao", "genero", "faixa_etaria"]),
        "vendas_por_periodo": lambda: sales.sales_by_period(stored.days()),
        "sazonalidade": lambda: sales.seasonality(stored.months()),
        "tendencia_vendas": lambda: sales.sales_trend(stored.months()),
        "receita_por_status": lambda: sales.payment_status_pivot(stored.months(), limits.statuses),
        "ranking_por_categoria": lambda: products.rank_in_category(stored.products(), of.products, limits.top),
        "ticket_categorias": lambda: products.ticket_by_category(stored.categories(of.products)),
        "margem_categorias": lambda: products.margin_by_category(stored.products(), of.products),
        "giro_estoque": lambda: products.stock_turnover(stored.products(), of.products, of.calendar),
        "metricas_fornecedores": lambda: products.supplier_metrics(stored.products(), of.products),
        "vendas_por_regiao": lambda: operations.regional_rollup(stored.addresses(), of.addresses),
    }
    shipping, amounts = stored.shipping(), stored.amounts()
    if shipping is not None:
        found["prazos_envio"] = lambda: operations.shipping_days(shipping, stored.freight())
    if amounts is not None:
        found["resultado_financeiro"] = lambda: sales.financials(amounts)
    return found
