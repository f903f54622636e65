"""Silver tables: six dimensions and the sales fact at line grain."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.scalars import age_in_years, calendar_parts, full_name, iso_year


def _prefixed(prefix: str, columns: Sequence[str]) -> list[Column]:
    """``nome`` becomes ``fornecedor_nome``; names that carry the prefix keep theirs."""
    return [
        F.col(c) if c.startswith(prefix) else F.col(c).alias(f"{prefix}_{c}") for c in columns
    ]


# Source columns of each dimension, in output order.
SUPPLIER_COLUMNS = ("id", "nome", "email", "telefone", "cnpj", "ativo", "criado_em")
CATEGORY_COLUMNS = ("id", "nome", "descricao", "ativa", "criado_em")
PRODUCT_TEXT = ("id", "nome", "descricao")
PRODUCT_FACTS = ("preco", "custo", "peso", "quantidade_estoque", "em_estoque", "ativo", "criado_em")
ADDRESS_TEXT = (
    "cep", "logradouro", "numero", "complemento", "bairro", "cidade", "estado",
    "endereco_principal", "criado_em",
)
# End of fixed values.


def dim_suppliers(suppliers: DataFrame) -> DataFrame:
    return suppliers.select(*_prefixed("fornecedor", SUPPLIER_COLUMNS)).distinct()


def dim_categories(categories: DataFrame) -> DataFrame:
    return categories.select(*_prefixed("categoria", CATEGORY_COLUMNS)).distinct()


def dim_products(products: DataFrame, categories: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Products with the names of their category and supplier, NULL where there is none.

    Products and lookups are made distinct before the joins, which keeps the
    result distinct. Afterwards the whole table would be grouped on top of the
    last join, and a supplier with a third of all products would be one task.
    Whether a lookup is broadcast is left to its measured size.
    """
    own = products.select(
        *_prefixed("produto", PRODUCT_TEXT),
        "categoria_id",
        "fornecedor_id",
        *_prefixed("produto", PRODUCT_FACTS),
    ).distinct()
    category_names = categories.select(
        F.col("id").alias("categoria_id"), F.col("nome").alias("categoria_nome")
    ).distinct()
    supplier_names = suppliers.select(
        F.col("id").alias("fornecedor_id"), F.col("nome").alias("fornecedor_nome")
    ).distinct()
    return (
        own.join(category_names, "categoria_id", "left")
        .join(supplier_names, "fornecedor_id", "left")
        .select(
            *[f"produto_{c}" for c in PRODUCT_TEXT],
            "categoria_id",
            "categoria_nome",
            "fornecedor_id",
            "fornecedor_nome",
            *[f"produto_{c}" for c in PRODUCT_FACTS],
        )
    )


def dim_customers(customers: DataFrame, as_of: dt.date) -> DataFrame:
    return customers.select(
        *_prefixed("cliente", ("id", "nome", "sobrenome")),
        full_name("nome", "sobrenome").alias("cliente_nome_completo"),
        *_prefixed("cliente", ("email", "telefone", "cpf", "data_nascimento")),
        age_in_years(F.col("data_nascimento"), as_of).alias("cliente_idade"),
        *_prefixed("cliente", ("genero", "criado_em")),
    ).distinct()


def dim_addresses(addresses: DataFrame) -> DataFrame:
    return addresses.select(
        F.col("id").alias("endereco_id"), "cliente_id", *_prefixed("endereco", ADDRESS_TEXT)
    ).distinct()


def dim_date(sales: DataFrame, with_iso_year: bool = False) -> DataFrame:
    """The dates that had sales.

    Dates are made distinct before the nine attributes are derived, so the
    shuffle carries one date per task and day instead of whole rows.
    """
    days = (
        sales.select(F.to_date("data_venda").alias("data")).filter(F.col("data").isNotNull()).distinct()
    )
    calendar = days.withColumns(calendar_parts(F.col("data")))
    return calendar.withColumn("ano_iso", iso_year(F.col("data"))) if with_iso_year else calendar


def sale_lines(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """Every line with the header of its sale, one row per line, not yet validated.

    Extra columns of the line table are kept at the end. Both sides are large;
    adaptive execution picks the join and splits a sale with very many lines.
    """
    known = {"id", "venda_id", "produto_id", "quantidade", "preco_unitario", "subtotal"}
    extra = [F.col(f"line.{c}") for c in lines.columns if c not in known | {"year", "month", "day"}]
    moment = F.col("sale.data_venda")
    return (
        sales.alias("sale")
        .join(lines.alias("line"), F.col("sale.id") == F.col("line.venda_id"))
        .select(
            F.col("line.venda_id").alias("venda_id"),
            F.col("line.id").alias("item_venda_id"),
            F.col("sale.cliente_id").alias("dim_cliente_id"),
            F.col("line.produto_id").alias("dim_produto_id"),
            F.col("sale.endereco_entrega_id").alias("dim_endereco_id"),
            F.to_date(moment).alias("dim_tempo_data"),
            *[F.col(f"line.{c}") for c in ("quantidade", "preco_unitario", "subtotal")],
            F.col("sale.subtotal").alias("subtotal_venda"),
            F.col("sale.frete").alias("frete"),
            F.col("sale.total").alias("total_venda"),
            F.col("sale.status").alias("status_venda"),
            *[F.col(f"sale.{c}") for c in ("metodo_pagamento", "status_pagamento", "data_venda")],
            F.year(moment).alias("ano"),
            F.month(moment).alias("mes"),
            F.dayofmonth(moment).alias("dia"),
            *extra,
        )
    )


# What a line needs to enter the fact.
POSITIVE = ("quantidade", "preco_unitario", "subtotal")
PRESENT = ("dim_cliente_id", "dim_produto_id")
# End of fixed values.


def line_checks(present: Sequence[str] = PRESENT) -> dict[str, Column]:
    """The condition of each check by column; a NULL fails it."""
    return {c: F.col(c) > 0 for c in POSITIVE} | {c: F.col(c).isNotNull() for c in present}


def valid_line(present: Sequence[str] = PRESENT) -> Column:
    return reduce(lambda a, b: a & b, line_checks(present).values())


def facts_sales(
    sales: DataFrame, lines: DataFrame, statuses: Sequence[str] | None = None
) -> DataFrame:
    """The sales fact: valid lines only, cancelled sales included unless ``statuses`` says otherwise."""
    facts = sale_lines(sales, lines).filter(valid_line())
    return facts.filter(F.col("status_venda").isin(*statuses)) if statuses else facts


def sales_with_lines(
    sales: DataFrame, lines: DataFrame, statuses: Sequence[str] | None = None
) -> DataFrame:
    """One row per sale that has a valid line: the fact at sale grain.

    Lines are added up per sale before they meet the header. A sale with a
    third of all lines then reaches the join as one row, and the header's
    values never travel once per line.
    """
    per_sale = (
        lines.filter(valid_line(("produto_id",)))
        .groupBy("venda_id")
        .agg(F.sum("quantidade").alias("quantidade"), F.count("*").alias("linhas"))
    )
    headers = sales.filter(F.col("cliente_id").isNotNull())
    if statuses:
        headers = headers.filter(F.col("status").isin(*statuses))
    moment = F.col("data_venda")
    return headers.join(per_sale, headers["id"] == per_sale["venda_id"]).select(
        "venda_id",
        F.col("total").alias("total_venda"),
        "frete",
        F.col("cliente_id").alias("dim_cliente_id"),
        F.col("endereco_entrega_id").alias("dim_endereco_id"),
        "data_venda",
        F.to_date(moment).alias("dim_tempo_data"),
        F.year(moment).alias("ano"),
        F.month(moment).alias("mes"),
        "status_pagamento",
        "quantidade",
        "linhas",
    )


def sales_from_facts(facts: DataFrame, *apart: str) -> DataFrame:
    """The same as :func:`sales_with_lines`, from a stored fact.

    Header values are equal on all lines of a sale, so a maximum reads them
    off; unlike ``first`` it does not depend on row order. Lines that differ in
    ``apart`` are kept apart even if they name the same sale.
    """
    header = (
        "total_venda", "frete", "dim_cliente_id", "dim_endereco_id", "data_venda",
        "dim_tempo_data", "ano", "mes", "status_pagamento",
    )
    return facts.groupBy("venda_id", *apart).agg(
        *[F.max(c).alias(c) for c in header if c not in apart],
        F.sum("quantidade").alias("quantidade"),
        F.count("*").alias("linhas"),
    )


def rejected_lines(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """The complement of :func:`facts_sales`, with the first check that failed."""
    return _with_reason(sales, lines).filter(F.col("motivo").isNotNull())


def rejection_report(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines per outcome; accepted and rejected together are all joined lines."""
    outcome = F.coalesce(F.col("motivo"), F.lit("aceita")).alias("resultado")
    return _with_reason(sales, lines).groupBy(outcome).agg(F.count("*").alias("linhas"))


def _with_reason(sales: DataFrame, lines: DataFrame) -> DataFrame:
    first_failure = F.coalesce(
        *[
            F.when(~F.coalesce(check, F.lit(False)), F.lit(name))
            for name, check in line_checks().items()
        ]
    )
    return sale_lines(sales, lines).withColumn("motivo", first_failure)


def run_totals(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.count("*").alias("total_records"),
        F.sum("total_venda").alias("total_value"),
        F.sum("quantidade").alias("total_items"),
    )
