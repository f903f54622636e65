import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from granary.plans import gold, silver
from tests.rows import bronze, values

JAN = dt.datetime(2025, 1, 10, 12)


def facts_of(spark, sales, lines):
    return silver.facts_sales(bronze(spark, "vendas", *sales), bronze(spark, "itens_venda", *lines))


def dims(spark, products=({},), categories=({},)):
    goods = bronze(spark, "produtos", *products)
    kinds = bronze(spark, "categorias", *categories)
    return silver.dim_products(goods, kinds, bronze(spark, "fornecedores", {})), silver.dim_categories(kinds)


BAD_LINES = [
    {"quantidade": 0}, {"quantidade": -1}, {"quantidade": None}, {"preco_unitario": 0},
    {"subtotal": None}, {"produto_id": None}, {"venda_id": 2},
]


def test_bad_lines_are_rejected_and_counted(spark):
    sales = bronze(spark, "vendas", {}, {"cliente_id": None})
    lines = bronze(spark, "itens_venda", {}, *BAD_LINES)
    assert values(silver.facts_sales(sales, lines), "item_venda_id") == [(1,)]
    reasons = values(silver.rejected_lines(sales, lines), "motivo")
    assert reasons == [("dim_cliente_id",), ("dim_produto_id",), ("preco_unitario",)] + [("quantidade",)] * 3 + [("subtotal",)]
    report = dict(values(silver.rejection_report(sales, lines), "resultado", "linhas"))
    assert report.pop("aceita") == 1 and sum(report.values()) == len(BAD_LINES)


def test_sale_without_lines_and_line_without_sale(spark):
    assert facts_of(spark, [{}, {}], [{"venda_id": 1}, {"venda_id": 99}]).count() == 1


def test_status_filter_is_optional(spark):
    sales = bronze(spark, "vendas", {"status": "ok"}, {"status": "cancelada"})
    lines = bronze(spark, "itens_venda", {"venda_id": 1}, {"venda_id": 2})
    assert silver.facts_sales(sales, lines).count() == 2
    assert values(silver.facts_sales(sales, lines, ["ok"]), "venda_id") == [(1,)]


def test_product_with_unknown_category_stays_in_the_dimension_only(spark):
    products, categories = dims(spark, [{}, {"categoria_id": 999}])
    assert values(products, "produto_id", "categoria_nome") == [(1, "c"), (2, None)]
    facts = facts_of(spark, [{}], [{"produto_id": 1}, {"produto_id": 2}])
    assert values(gold.top_products(facts, products, categories), "produto_id") == [(1,)]


def test_dimensions_drop_equal_rows(spark):
    rows = bronze(spark, "clientes", {"id": 1}, {"id": 1}, {"id": 1, "nome": "Bia"})
    assert silver.dim_customers(rows, dt.date(2025, 1, 1)).count() == 2
    assert silver.dim_suppliers(bronze(spark, "fornecedores", {"id": 1}, {"id": 1})).count() == 1
    assert silver.dim_addresses(bronze(spark, "enderecos", {"id": 1}, {"id": 1})).count() == 1


def test_calendar_holds_each_sale_date_once(spark):
    sales = bronze(spark, "vendas", {}, {}, {"data_venda": None}, {"data_venda": dt.datetime(2025, 1, 11)})
    assert values(silver.dim_date(sales), "data") == [(dt.date(2025, 1, 10),), (dt.date(2025, 1, 11),)]


def test_line_grain_against_sale_grain(spark):
    facts = facts_of(spark, [{"total": 30}], [{}, {}, {}])
    by_line = gold.monthly_sales(facts).first()
    by_sale = gold.monthly_sales_by_order(silver.sales_from_facts(facts)).first()
    assert (by_line["receita_total"], by_line["total_vendas"], by_line["clientes_unicos"]) == (90, 3, 3)
    assert (by_sale["receita_total"], by_sale["total_vendas"], by_sale["clientes_unicos"]) == (30, 1, 1)
    assert by_line["ticket_medio"] == by_sale["ticket_medio"] == 30


def test_approximate_customers(spark):
    facts = facts_of(spark, [{}, {"cliente_id": 2}], [{}, {"venda_id": 2}])
    assert gold.monthly_sales_by_order(silver.sales_from_facts(facts), approximate=True).first()["clientes_unicos"] == 2


def test_vip_limit_is_tested_after_rounding(spark):
    facts = spark.createDataFrame(
        [(i, i, total, 1, JAN) for i, total in enumerate([1000.00, 1000.004, 1000.01], 1)],
        "venda_id long, dim_cliente_id long, total_venda double, quantidade int, data_venda timestamp",
    )
    people = silver.dim_customers(bronze(spark, "clientes", {}, {}, {}), dt.date(2025, 1, 1))
    assert values(gold.vip_customers(facts, people), "cliente_id", "valor_total_compras") == [(3, 1000.01)]


def test_changed_customer_doubles_only_without_key_dedup(spark):
    from granary.operators.dedup import latest_by_key

    facts = facts_of(spark, [{"total": 2000}], [{}])
    rows = bronze(
        spark, "clientes",
        {"id": 1, "nome": "Ana", "criado_em": dt.datetime(2025, 1, 1)},
        {"id": 1, "nome": "Bia", "criado_em": dt.datetime(2025, 1, 2)},
    )
    day = dt.date(2025, 1, 1)
    assert gold.vip_customers(facts, silver.dim_customers(rows, day)).count() == 2
    newest = latest_by_key(rows, ["id"], ["criado_em"])
    assert values(gold.vip_customers(facts, silver.dim_customers(newest, day)), "cliente_nome_completo") == [("Bia Silva",)]


def test_tie_at_the_last_rank_keeps_the_lower_id(spark):
    products, categories = dims(spark, [{}, {}, {}])
    facts = facts_of(
        spark, [{}, {"total": 5}], [{"produto_id": 1}, {"venda_id": 2, "produto_id": 3}, {"venda_id": 2, "produto_id": 2}]
    )
    assert values(gold.top_products(facts, products, categories, limit=2), "produto_id") == [(1,), (2,)]


def test_summary_of_nothing_is_one_row(spark):
    row = gold.executive_summary(facts_of(spark, [{}], [{"quantidade": 0}]), "2025-01-31").first()
    assert row["total_transacoes"] == 0 and row["total_clientes"] == 0
    assert row["receita_total_periodo"] is None and row["ticket_medio_geral"] is None
    assert row["periodo_analise"] == "2025-01-31"


def test_recent_period(spark):
    facts = spark.createDataFrame([(2023, 12), (2024, 1), (2025, 1), (2025, 12)], "ano int, mes int")
    assert values(gold.recent_period(facts, dt.date(2025, 6, 1)), "ano") == [(2024,), (2025,), (2025,)]


def test_daily_sums_to_monthly(bed):
    from granary.catalogue.base import calendar, facts

    fact = facts(bed)
    daily = gold.daily_sales(fact, calendar(bed))
    summed = daily.groupBy("ano", "mes").agg(F.sum("receita_dia"), F.sum("vendas_dia"), F.sum("itens_dia"))
    monthly = gold.monthly_sales(fact).select("ano", "mes", "receita_total", "total_vendas", "itens_vendidos")
    assert values(summed, *summed.columns) == values(monthly, *monthly.columns)


def test_accepted_and_rejected_are_all_lines(bed):
    sales, lines = bed.vendas(), bed.itens_venda()
    accepted, rejected = silver.facts_sales(sales, lines).count(), silver.rejected_lines(sales, lines).count()
    assert accepted + rejected == silver.sale_lines(sales, lines).count() == 6000


def test_money_columns_stay_decimal(spark):
    facts = facts_of(spark, [{"total": "10.05"}], [{}, {}])
    row = gold.monthly_sales(facts).first()
    assert row["receita_total"] == Decimal("20.10") and row["ticket_medio"] == Decimal("10.05")


def test_sale_grain_is_the_same_from_sources_and_from_the_fact(spark, bed):
    direct = silver.sales_with_lines(bed.vendas(), bed.itens_venda())
    stored = silver.sales_from_facts(silver.facts_sales(bed.vendas(), bed.itens_venda()))
    assert sorted(direct.columns) == sorted(stored.columns)
    assert values(direct, *direct.columns) == values(stored, *direct.columns)
    sales = bronze(spark, "vendas", {"status": "x"}, {"cliente_id": None}, {})
    lines = bronze(spark, "itens_venda", {}, *BAD_LINES, {"venda_id": 3})
    assert values(silver.sales_with_lines(sales, lines), "venda_id", "linhas") == [(1, 1), (3, 1)]
    assert values(silver.sales_with_lines(sales, lines, ["x"]), "venda_id") == [(1,)]


def test_freight_counts_once_per_sale(spark):
    from granary.plans.analyses import operations

    sales = [{"frete": 10, "total": 100}, {"frete": 0, "total": 100}]
    lines = [{"venda_id": 1}] + [{"venda_id": 2}] * 9
    facts = facts_of(spark, sales, lines).withColumn("data_envio", F.lit(JAN))
    found = operations.shipping_days(operations.shipping_histogram(facts, "ano"), operations.yearly_freight(facts))
    assert found.first()["participacao_frete"] == 0.05


def test_main_address_of_a_customer(spark):
    from granary.plans.analyses import customers

    rows = [{"id": 1, "cliente_id": 1}, {"id": 2, "cliente_id": 1, "endereco_principal": True}, {"id": 3, "cliente_id": 2}]
    found = customers.main_address(silver.dim_addresses(bronze(spark, "enderecos", *rows)))
    assert values(found, "cliente_id", "endereco_id") == [(1, 2), (2, 3)]
