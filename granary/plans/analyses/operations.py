"""Regions and shipping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.money import rounded_mean


def address_sales(sales: DataFrame) -> DataFrame:
    """One row per address of delivery."""
    return sales.groupBy(F.col("dim_endereco_id").alias("endereco_id")).agg(
        F.count("*").alias("vendas"), F.sum("total_venda").alias("receita")
    )


def regional_rollup(per_address: DataFrame, addresses: DataFrame) -> DataFrame:
    """Sales and revenue by state and city of delivery, with subtotals and a total.

    ``nivel`` is 0 for a city, 1 for a state, 3 for everything. The rollup
    expands cities, not sales.
    """
    per_city = (
        per_address.join(
            addresses.select(
                "endereco_id",
                F.col("endereco_estado").alias("estado"),
                F.col("endereco_cidade").alias("cidade"),
            ),
            "endereco_id",
        )
        .groupBy("estado", "cidade")
        .agg(F.sum("vendas").alias("vendas"), F.sum("receita").alias("receita"))
    )
    return per_city.rollup("estado", "cidade").agg(
        F.grouping_id().cast("int").alias("nivel"),
        F.sum("vendas").alias("vendas"),
        F.sum("receita").alias("receita"),
    )


def shipping_histogram(facts: DataFrame, *keys: str, shipped: str = "data_envio") -> DataFrame:
    """Lines per number of days from sale to shipment, and ``keys``."""
    days = F.date_diff(F.to_date(shipped), F.col("dim_tempo_data"))
    return facts.groupBy(*keys, days.alias("dias")).agg(F.count("*").alias("linhas"))


def yearly_freight(facts: DataFrame) -> DataFrame:
    """Freight and total of the sales of a year; a sale counts once, however many lines it has."""
    per_sale = facts.groupBy("ano", "venda_id").agg(F.max("frete").alias("frete"), F.max("total_venda").alias("total"))
    return per_sale.groupBy("ano").agg(F.sum("frete").alias("frete"), F.sum("total").alias("receita"))


def shipping_days(histogram: DataFrame, freight: DataFrame) -> DataFrame:
    """Days from sale to shipment per year of sale.

    Lines that were shipped before they were sold are counted as invalid and
    left out of mean and quantiles. Quantiles are taken from the number of
    lines per day count, which is bounded by the days of the covered period,
    and given to six digits, because interpolation leaves noise beyond.
    """
    freight = freight.select("ano", F.col("frete").cast("double").alias("_freight"), F.col("receita").cast("double").alias("_total"))
    valid = F.col("dias") >= 0
    lines = F.sum(F.when(valid, F.col("linhas")))
    quantiles = F.percentile(
        F.when(valid, F.col("dias")),
        F.array(F.lit(0.5), F.lit(0.9)),
        F.when(valid, F.col("linhas")).otherwise(0),
    )
    summed = histogram.groupBy("ano").agg(
        F.coalesce(lines, F.lit(0)).alias("envios"),
        F.coalesce(F.sum(F.when(~valid, F.col("linhas"))), F.lit(0)).alias("invalidos"),
        F.sum(F.when(valid, F.col("dias") * F.col("linhas"))).alias("_days"),
        quantiles.alias("_q"),
    )
    joined = summed.alias("s").join(freight.alias("f"), F.col("s.ano").eqNullSafe(F.col("f.ano")))
    return joined.select(
        F.col("s.ano").alias("ano"),
        "envios",
        "invalidos",
        rounded_mean(F.col("_days"), F.col("envios"), True).alias("dias_medio"),
        F.round(F.col("_q")[0], 6).alias("dias_mediana"),
        F.round(F.col("_q")[1], 6).alias("dias_p90"),
        F.when(F.col("_total") != 0, F.round(F.col("_freight") / F.col("_total"), 9)).alias("participacao_frete"),
    )
