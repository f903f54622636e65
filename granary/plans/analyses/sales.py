"""Sales over time. ``sales`` is the fact at sale grain, ``facts`` at line grain; the analyses take their reductions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.money import rounded_mean, rounded_quotient


def day_sales(sales: DataFrame) -> DataFrame:
    """One row per day: sales, revenue, items."""
    return (
        sales
        .groupBy(F.col("dim_tempo_data").alias("dia"))
        .agg(
            F.count("*").alias("vendas"),
            F.sum("total_venda").alias("receita"),
            F.sum("quantidade").alias("itens"),
        )
    )


def sales_by_period(days: DataFrame) -> DataFrame:
    """Sales, revenue and items per day, ISO week, month and year. The four groupings expand days, not sales."""
    grains = {"dia": "day", "semana": "week", "mes": "month", "ano": "year"}
    daily = days.withColumns(
        {name: F.trunc("dia", unit) for name, unit in grains.items() if name != "dia"}
    )
    grouped = daily.groupingSets([[F.col(g)] for g in grains], *grains).agg(
        *[F.sum(m).alias(m) for m in ("vendas", "receita", "itens")],
        *[F.grouping(g).alias(f"_{g}") for g in grains],
    )
    label = F.coalesce(*[F.when(F.col(f"_{g}") == 0, F.lit(g)) for g in grains])
    start = F.coalesce(*[F.when(F.col(f"_{g}") == 0, F.col(g)) for g in grains])
    return grouped.select(
        label.alias("periodo"), start.alias("inicio"), "vendas", "receita", "itens"
    )


def month_sales(sales: DataFrame) -> DataFrame:
    """Revenue per calendar month and payment status."""
    return sales.groupBy("ano", "mes", "status_pagamento").agg(F.sum("total_venda").alias("receita"))


def monthly_revenue(months: DataFrame) -> DataFrame:
    """Revenue per calendar month, with a month number that grows by one each month."""
    return (
        months
        .groupBy("ano", "mes")
        .agg(F.sum("receita").alias("receita"))
        .withColumn("_month", F.col("ano") * 12 + F.col("mes"))
    )


def seasonality(months: DataFrame) -> DataFrame:
    """Per month of the year: mean monthly revenue against the mean of all months.

    The window without keys spans calendar months, twelve rows per year.
    """
    months = monthly_revenue(months)
    everything = Window.partitionBy()
    overall = months.withColumns(
        {"_all": F.sum("receita").over(everything), "_count": F.count("*").over(everything)}
    )
    return overall.groupBy("mes").agg(
        F.count("*").alias("meses"),
        rounded_mean(F.sum("receita"), F.count("*"), True).alias("receita_media"),
        (
            F.sum("receita").cast("double")
            / F.count("*")
            / (F.max("_all").cast("double") / F.max("_count"))
        ).alias("indice_sazonal"),
    )


def sales_trend(months: DataFrame) -> DataFrame:
    """Monthly revenue, its change on the month and year before, and a three-month mean.

    Distances are calendar months: a month without sales is a gap, not the
    month before. The window spans calendar months, twelve rows per year.
    """
    months = monthly_revenue(months)
    by_month = Window.orderBy("_month")
    current = F.col("receita").cast("double")

    def change(distance: int):
        before = F.sum("receita").over(by_month.rangeBetween(-distance, -distance)).cast("double")
        return F.when(before != 0, (current - before) / before)

    last_three = by_month.rangeBetween(-2, 0)
    return months.select(
        "ano",
        "mes",
        "receita",
        change(1).alias("variacao_mensal"),
        change(12).alias("variacao_anual"),
        rounded_quotient(
            F.sum("receita").over(last_three), F.count("receita").over(last_three)
        ).alias("media_movel_3m"),
    )


def conversion_daily(events: DataFrame, time: str, user: str, kind: str) -> DataFrame:
    """Per day: users who bought, users who viewed, and their ratio.

    Each user and day is reduced to two flags first, so one shuffle serves both
    distinct counts.
    """
    per_user = events.groupBy(F.to_date(time).alias("data"), F.col(user).alias("_user")).agg(
        F.max(F.col(kind) == "view").alias("_viewed"),
        F.max(F.col(kind) == "purchase").alias("_bought"),
    )
    counted = per_user.filter(F.col("_user").isNotNull()).groupBy("data").agg(
        F.count_if("_viewed").alias("visitantes"), F.count_if("_bought").alias("compradores")
    )
    ratio = F.col("compradores").cast("double") / F.col("visitantes")
    return counted.withColumn("taxa_conversao", F.when(F.col("visitantes") > 0, ratio))


def payment_status_pivot(months: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """Monthly revenue, one column per payment status.

    The statuses are given, so no extra pass looks for them and one conditional
    sum each is enough.
    """
    return months.groupBy("ano", "mes").agg(
        *[
            F.sum(F.when(F.col("status_pagamento") == s, F.col("receita"))).alias(f"receita_{s.lower()}")
            for s in statuses
        ]
    )


def amounts() -> list[Column]:
    """Sums of gross amount, discount and tax of lines. Discount and tax are rates per line; tax is on the discounted amount."""
    gross = F.col("subtotal").cast("decimal(18,2)")
    discount = gross * F.col("desconto")
    tax = (gross - discount) * F.col("imposto")
    return [F.sum(gross).alias("_gross"), F.sum(discount).alias("_discount"), F.sum(tax).alias("_tax")]


def month_amounts(facts: DataFrame) -> DataFrame:
    return facts.groupBy("ano", "mes").agg(*amounts())


def financials(amounts: DataFrame) -> DataFrame:
    """Gross, discount, tax and net revenue per month, from line subtotals. Sums are exact and rounded once."""
    return (
        amounts
        .select(
            "ano",
            "mes",
            F.col("_gross").alias("receita_bruta"),
            F.round("_discount", 2).alias("descontos"),
            F.round("_tax", 2).alias("impostos"),
            F.round(F.col("_gross") - F.col("_discount"), 2).alias("receita_liquida"),
        )
    )
