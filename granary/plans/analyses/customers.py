"""Who buys, how often, and for how much. ``buyers`` has one row per customer, see :func:`customer_sales`."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.money import rounded_mean, rounded_quotient
from granary.functions.scalars import month_index
from granary.operators.quantiles import exact_quantiles
from granary.sinks.lake import stage

QUINTILES = (0.2, 0.4, 0.6, 0.8)
AGE_BANDS = (25, 35, 45, 55)


def customer_sales(sales: DataFrame) -> DataFrame:
    """One row per customer: sales, revenue, first and last sale. ``sales`` is the fact at sale grain."""
    return (
        sales
        .groupBy(F.col("dim_cliente_id").alias("cliente_id"))
        .agg(
            F.count("*").alias("vendas"),
            F.sum("total_venda").alias("receita"),
            F.min("data_venda").alias("primeira_venda"),
            F.max("data_venda").alias("ultima_venda"),
        )
    )


def customer_category(buyers: DataFrame, silver_from: float, gold_from: float) -> DataFrame:
    """Spend bands: bronze below ``silver_from``, gold from ``gold_from`` on."""
    spend = F.col("receita")
    band = (
        F.when(spend >= gold_from, F.lit("ouro"))
        .when(spend >= silver_from, F.lit("prata"))
        .otherwise(F.lit("bronze"))
    )
    return buyers.select("cliente_id", "vendas", "receita", band.alias("categoria_cliente"))


def ticket_by_customer(buyers: DataFrame) -> DataFrame:
    mean = rounded_mean(F.col("receita"), F.col("vendas"), True)
    return buyers.select("cliente_id", "vendas", "receita", mean.alias("ticket_medio"))


def customer_ltv(buyers: DataFrame, horizon_months: int = 12) -> DataFrame:
    """Lifetime value: mean sale times sales per month times months.

    ``valor_historico`` takes the customer's active months, first to last sale
    inclusive; ``valor_projetado`` takes the horizon.
    """
    months = month_index(F.col("ultima_venda")) - month_index(F.col("primeira_venda")) + 1
    per_month = F.col("vendas").cast("double") / F.col("meses_ativos")
    return (
        buyers
        .withColumn("meses_ativos", months)
        .select(
            "cliente_id",
            "vendas",
            rounded_mean(F.col("receita"), F.col("vendas"), True).alias("valor_medio"),
            "meses_ativos",
            per_month.alias("vendas_por_mes"),
            F.col("receita").alias("valor_historico"),
            rounded_quotient(F.col("receita") * horizon_months, F.col("meses_ativos")).alias("valor_projetado"),
        )
    )


def _score(value: Column, limits: Sequence[float], best_is_low: bool) -> Column:
    """1 to 5 by the quintile limits; a value on a limit belongs to the lower fifth."""
    above = F.lit(0)
    for limit in limits:
        above = above + (value > limit).cast("int")
    return (5 - above) if best_is_low else (1 + above)


def rfm_segments(buyers: DataFrame, as_of: dt.date) -> DataFrame:
    """Recency, frequency and spend scores, and the segment they put a customer in.

    Customers are written out once, because the limits and the scores both read
    them. The three measures become one column, so one pass finds all limits,
    and the limits come back as three constants: no ranking of all customers.
    """
    measures = ("recencia", "frequencia", "valor")
    people, _ = stage(
        buyers.select(
            "cliente_id",
            F.date_diff(F.lit(as_of), F.to_date("ultima_venda")).alias("recencia"),
            F.col("vendas").alias("frequencia"),
            F.col("receita").alias("valor"),
        ),
        "rfm-customers",
    )
    long = people.select([F.col(m).cast("double").alias(m) for m in measures]).unpivot(
        [], list(measures), "medida", "x"
    )
    found = exact_quantiles(long, ["medida"], "x", QUINTILES).select(
        "medida", F.transform("quantis", lambda q: F.round(q, 6)).alias("quantis")
    )
    limits = {row["medida"]: row["quantis"] for row in found.collect()}

    def score(name: str, best_is_low: bool = False) -> Column:
        return _score(F.col(name).cast("double"), limits.get(name, []), best_is_low)

    scored = people.withColumns(
        {
            "nota_recencia": score("recencia", best_is_low=True),
            "nota_frequencia": score("frequencia"),
            "nota_valor": score("valor"),
        }
    )
    r, f, m = (F.col(f"nota_{x}") for x in measures)
    segment = (
        F.when((r >= 4) & (f >= 4) & (m >= 4), F.lit("campeoes"))
        .when((f >= 4) & (r >= 3), F.lit("fieis"))
        .when((r <= 2) & (f >= 3), F.lit("em_risco"))
        .when((r >= 4) & (f <= 2), F.lit("novos"))
        .when(r <= 2, F.lit("perdidos"))
        .otherwise(F.lit("regulares"))
    )
    return scored.withColumn("segmento_rfm", segment)


def age_band(age: Column) -> Column:
    band = F.when(age < AGE_BANDS[0], F.lit(f"ate {AGE_BANDS[0] - 1}"))
    for low, high in zip(AGE_BANDS, AGE_BANDS[1:]):
        band = band.when(age < high, F.lit(f"{low} a {high - 1}"))
    return F.when(age.isNotNull(), band.otherwise(F.lit(f"{AGE_BANDS[-1]} ou mais")))


def main_address(addresses: DataFrame) -> DataFrame:
    """One address of each customer: a main one before others, then the lowest id."""
    first = F.struct(F.when(F.col("endereco_principal"), 0).otherwise(1), "endereco_id")
    columns = [F.min_by(c, first).alias(c) for c in addresses.columns if c != "cliente_id"]
    return addresses.groupBy("cliente_id").agg(*columns)


def sales_by_segment(
    buyers: DataFrame, people: DataFrame, attributes: Sequence[str]
) -> DataFrame:
    """Customers, sales and revenue per value of each attribute.

    ``people`` has one row per ``cliente_id`` with the attributes as text. All
    attributes are grouped in one pass over customers, not over sales.
    """
    joined = buyers.join(people.select("cliente_id", *attributes), "cliente_id")
    long = joined.select("vendas", "receita", *attributes).unpivot(
        ["vendas", "receita"], list(attributes), "dimensao", "grupo"
    )
    return long.groupBy("dimensao", "grupo").agg(
        F.count("*").alias("clientes"),
        F.sum("vendas").alias("vendas"),
        F.sum("receita").alias("receita"),
    )
