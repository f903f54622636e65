"""Cleaning and checking as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.catalogue.base import query
from granary.functions.identity import clean_text as cleaned
from granary.functions.identity import emails_in, valid_email
from granary.operators.dedup import latest_by_key
from granary.operators import integrity
from granary.plans import quality, rules
from granary.sources.testbed import Testbed


@query
def dedup_latest(bed: Testbed) -> DataFrame:
    """(order, line number) repeats in the lines; the line shipped last stays."""
    lines = bed.raw("lineitem")
    newest = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]
    return latest_by_key(lines, ["l_orderkey", "l_linenumber"], newest)


@query
def orphan_report(bed: Testbed) -> DataFrame:
    sales, lines, goods = bed.vendas(), bed.itens_venda(), bed.produtos()
    return integrity.orphan_report(
        [
            ("itens_venda.venda_id", lines, "venda_id", sales, "id"),
            ("itens_venda.produto_id", lines, "produto_id", goods, "id"),
            ("vendas.cliente_id", sales, "cliente_id", bed.clientes(), "id"),
            ("vendas.endereco_entrega_id", sales, "endereco_entrega_id", bed.enderecos(), "id"),
            ("produtos.categoria_id", goods, "categoria_id", bed.categorias(), "id"),
            ("produtos.fornecedor_id", goods, "fornecedor_id", bed.fornecedores(), "id"),
        ]
    )


@query
def typed_columns(bed: Testbed) -> DataFrame:
    """Text to numbers and timestamps; every refused value is counted."""
    sale_text = bed.raw("orders").select(
        F.substring_index("o_orderpriority", "-", 1).alias("prioridade"),
        F.col("o_orderstatus").alias("situacao"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("momento"),
    )
    page_text = bed.raw("pages").select(F.element_at(F.split("url", "/"), -1).alias("pagina"))
    return quality.union_all(
        [
            quality.conversion_report(
                sale_text, {"prioridade": "int", "situacao": "double", "momento": "timestamp"}
            ),
            quality.conversion_report(page_text, {"pagina": "bigint"}),
        ]
    )


@query
def clean_text(bed: Testbed) -> DataFrame:
    return bed.raw("documents").select("doc_id", cleaned(F.col("text")).alias("texto"))


@query
def required_fields(bed: Testbed) -> DataFrame:
    return quality.union_all(
        [
            integrity.null_counts("vendas", bed.vendas(), ["id", "cliente_id", "total", "data_venda"]),
            integrity.null_counts(
                "itens_venda", bed.itens_venda(), ["venda_id", "produto_id", "quantidade", "subtotal"]
            ),
            integrity.null_counts("clientes", bed.clientes(), ["id", "nome", "email", "cpf"]),
        ]
    )


@query
def rule_report(bed: Testbed) -> DataFrame:
    """Rows per rule that break it; customers and products in the forms that a careless source would send."""
    key, wide = F.col("id"), F.lit("  ")
    people = bed.clientes().withColumns(
        {
            "email": F.when(key % 5 == 0, F.concat(F.col("email"), F.lit(" (casa)"))).when(key % 7 == 0, F.lit(None)).otherwise(F.concat(wide, F.col("email"))),
            "cpf": F.when(key % 3 == 0, F.lit("529.982.247-25")).when(key % 3 == 1, F.lit("529.982.247-26")),
            "id": F.when(key % 11 != 0, key),
        }
    )
    goods = bed.produtos().withColumns({"preco": F.when(key % 4 == 0, -F.col("preco")).otherwise(F.col("preco")), "categoria_id": F.when(key % 9 != 0, F.col("categoria_id"))})
    tables = {"clientes": people, "produtos": goods}
    found = {name: rules.judged(rules.standardised(rows, name), rules.RULES[name]) for name, rows in tables.items()}
    return rules.reasons(found, rules.RULES)


@query
def refused_lines(bed: Testbed) -> DataFrame:
    """Lines that the fact leaves out, with all reasons, after some were spoilt."""
    sales = bed.vendas().withColumn("cliente_id", F.when(F.col("id") % 13 != 0, F.col("cliente_id")))
    lines = bed.itens_venda().withColumns(
        {
            "quantidade": F.when(F.col("venda_id") % 5 == 0, F.lit(0)).otherwise(F.col("quantidade")),
            "produto_id": F.when(F.col("produto_id") % 10 != 0, F.col("produto_id")),
        }
    )
    return rules.refused_lines(sales, lines).select("item_venda_id", F.array_join("motivos", ",").alias("motivos"))


@query
def email_check(bed: Testbed) -> DataFrame:
    """Documents with an address in them, and whether the whole text is one."""
    text = F.col("text")
    found = bed.raw("documents").select(
        "doc_id",
        F.size(emails_in(text)).alias("enderecos"),
        valid_email(text).alias("texto_e_email"),
    )
    return found.filter(F.col("enderecos") > 0)


@query
def outliers_iqr(bed: Testbed) -> DataFrame:
    events = bed.raw("events").select("event_id", "event_type", "value")
    return quality.outliers_iqr(events, "event_type", "value")
