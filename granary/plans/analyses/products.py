"""What sells, at which margin, and from which stock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.money import rounded_mean
from granary.sinks.lake import stage


def line_sums() -> list[Column]:
    return [
        F.sum("quantidade").alias("quantidade"),
        F.sum("subtotal").alias("receita"),
        F.sum(F.col("preco_unitario") * F.col("quantidade")).alias("valor_vendido"),
        F.count("*").alias("linhas"),
    ]


def product_sales(facts: DataFrame) -> DataFrame:
    """One row per product, ``sold`` in what follows. Products are joined to this, never to the fact itself."""
    return facts.groupBy(F.col("dim_produto_id").alias("produto_id")).agg(*line_sums())


def rank_in_category(sold: DataFrame, products: DataFrame, top: int = 10) -> DataFrame:
    """Best sellers by quantity in each category.

    Spark keeps only ``top`` rows per category and task before the shuffle, so
    a category with most of the products stays small.
    """
    best_first = Window.partitionBy("categoria_id").orderBy(F.desc("quantidade"), "produto_id")
    return (
        sold
        .join(products.select("produto_id", "produto_nome", "categoria_id", "categoria_nome"), "produto_id")
        .withColumn("posicao", F.row_number().over(best_first))
        .filter(F.col("posicao") <= top)
        .select(
            "categoria_id", "categoria_nome", "posicao", "produto_id", "produto_nome",
            "quantidade", "receita",
        )
    )


def category_sales(facts: DataFrame, products: DataFrame, *keys: str) -> DataFrame:
    """Sales that have a category, and what they spend in it, per category and ``keys`` of the fact.

    Sales per category cannot be added up from products, so the lines are
    joined, once for both measures.
    """
    joined = facts.withColumnRenamed("dim_produto_id", "produto_id").join(
        products.select("produto_id", "categoria_id", "categoria_nome"), "produto_id"
    )
    return category_sums(joined, *keys, "categoria_id", "categoria_nome")


def category_sums(lines: DataFrame, *keys: str) -> DataFrame:
    """The two measures of :func:`category_sales`, of lines that have their category."""
    return lines.groupBy(*keys).agg(
        F.count_distinct("venda_id").alias("vendas"),
        F.sum("subtotal").alias("receita"),
    )


def ticket_by_category(per_category: DataFrame) -> DataFrame:
    """Mean spend per sale and category, over the sales that have the category."""
    return per_category.withColumn("ticket_medio", rounded_mean(F.col("receita"), F.col("vendas"), True))


def margin_by_category(sold: DataFrame, products: DataFrame) -> DataFrame:
    """Sold value less cost, and its share of the sold value."""
    costed = sold.join(
        products.select("produto_id", "categoria_id", "categoria_nome", "produto_custo"), "produto_id"
    )
    summed = costed.groupBy("categoria_id", "categoria_nome").agg(
        F.sum("valor_vendido").alias("receita"),
        F.sum(F.col("produto_custo") * F.col("quantidade")).alias("custo"),
    )
    margin = F.col("receita") - F.col("custo")
    share = margin.cast("double") / F.col("receita").cast("double")
    return summed.withColumns(
        {"margem": margin, "margem_relativa": F.when(F.col("receita") != 0, share)}
    )


def stock_turnover(sold: DataFrame, products: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sold quantity over stock, and the days the stock lasts at the rate sold.

    The period is that of the calendar dimension. Products never sold stay,
    with zero sold. No stock means no turnover; nothing sold, no cover.
    """
    days = calendar.agg((F.date_diff(F.max("data"), F.min("data")) + 1).alias("d")).scalar()
    quantities = sold.select("produto_id", F.col("quantidade").alias("vendido"))
    stock = F.col("estoque").cast("double")
    return (
        products.select("produto_id", F.col("produto_quantidade_estoque").alias("estoque"))
        .join(quantities, "produto_id", "left")
        .select(
            "produto_id",
            "estoque",
            F.coalesce("vendido", F.lit(0)).alias("vendido"),
        )
        .withColumns(
            {
                "giro": F.when(stock != 0, F.col("vendido") / stock),
                "dias_cobertura": F.when(F.col("vendido") != 0, stock * days / F.col("vendido")),
            }
        )
    )


def supplier_metrics(sold: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, lines, products and revenue share per supplier; unknown ones as NULL."""
    per_supplier, _ = stage(
        sold
        .join(products.select("produto_id", "fornecedor_id", "fornecedor_nome"), "produto_id")
        .groupBy("fornecedor_id", "fornecedor_nome")
        .agg(
            F.sum("receita").alias("receita"),
            F.sum("linhas").alias("linhas"),
            F.count("*").alias("produtos"),
        ),
        "suppliers",
    )
    total = per_supplier.agg(F.sum("receita").cast("double").alias("t")).scalar()
    return per_supplier.withColumn("participacao", F.col("receita").cast("double") / total)
