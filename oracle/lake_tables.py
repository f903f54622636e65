"""Silver and gold tables."""

from oracle.pieces import CALENDAR, CUSTOMERS, DAY_PARTS, FACTS, PRODUCTS, SALES
from oracle.pieces import days_after, half_up, money_mean, money_sum

FACT_COLUMNS = """venda_id, item_venda_id, dim_cliente_id, dim_produto_id, dim_endereco_id,
  dim_tempo_data, quantidade, preco_unitario, subtotal, subtotal_venda, frete, total_venda,
  status_venda, metodo_pagamento, status_pagamento, data_venda, ano, mes, dia"""

UNIT_PRICE_MEAN = half_up("sum(CAST(round(preco_unitario * 100) AS BIGINT))", "count(*)")


def _top_products(value: str) -> str:
    return f"""WITH {FACTS}, {PRODUCTS}
SELECT produto_id, produto_nome, categoria_nome,
       CAST(sum(quantidade) AS BIGINT) AS quantidade_vendida,
       {money_sum(value)} AS receita_produto, count(*) AS numero_vendas,
       {UNIT_PRICE_MEAN} AS preco_medio
FROM facts JOIN products ON dim_produto_id = produto_id
GROUP BY 1, 2, 3 ORDER BY receita_produto DESC, produto_id LIMIT 100"""


def _vip(source: str, extra: str) -> str:
    return f"""WITH {FACTS}{extra}, {CUSTOMERS}
SELECT cliente_id, cliente_nome_completo, cliente_email,
       {money_sum('total_venda')} AS valor_total_compras, count(*) AS numero_compras,
       {money_mean('total_venda')} AS ticket_medio_cliente,
       max(data_venda) AS ultima_compra, min(data_venda) AS primeira_compra
FROM {source} JOIN customers ON dim_cliente_id = cliente_id
GROUP BY 1, 2, 3 HAVING valor_total_compras > 1000
ORDER BY valor_total_compras DESC, cliente_id LIMIT 500"""


def _monthly(source: str, extra: str, customers: str) -> str:
    return f"""WITH {FACTS}{extra}
SELECT ano, mes, count(*) AS total_vendas, {money_sum('total_venda')} AS receita_total,
       CAST(sum(quantidade) AS BIGINT) AS itens_vendidos,
       {money_mean('total_venda')} AS ticket_medio, {customers} AS clientes_unicos
FROM {source} GROUP BY 1, 2"""


def _daily(source: str, extra: str) -> str:
    return f"""WITH {FACTS}{extra}, {CALENDAR}
SELECT data, c.ano, c.mes, c.dia, dia_semana_nome, tipo_dia, count(*) AS vendas_dia,
       {money_sum('total_venda')} AS receita_dia, CAST(sum(quantidade) AS BIGINT) AS itens_dia,
       {money_mean('total_venda')} AS ticket_medio_dia
FROM {source} f JOIN calendar c ON dim_tempo_data = data
GROUP BY 1, 2, 3, 4, 5, 6"""


def _summary(source: str, extra: str, customers: str) -> str:
    return f"""WITH {FACTS}{extra}
SELECT count(*) AS total_transacoes, {money_sum('total_venda')} AS receita_total_periodo,
       CAST(sum(quantidade) AS BIGINT) AS total_itens_vendidos,
       {money_mean('total_venda')} AS ticket_medio_geral, {customers} AS total_clientes,
       max(data_venda) AS data_ultima_venda, min(data_venda) AS data_primeira_venda,
       '2001-12-31' AS periodo_analise
FROM {source}"""


SQL = {
    "dim_suppliers": f"""
SELECT DISTINCT s_suppkey AS fornecedor_id, s_name AS fornecedor_nome,
       CAST(NULL AS VARCHAR) AS fornecedor_email, CAST(NULL AS VARCHAR) AS fornecedor_telefone,
       CAST(NULL AS VARCHAR) AS fornecedor_cnpj, true AS fornecedor_ativo,
       {days_after('1995-01-01', 's_suppkey % 2400')} AS fornecedor_criado_em
FROM supplier""",
    "dim_categories": f"""
SELECT DISTINCT CAST(split_part(p_brand, '#', 2) AS BIGINT) AS categoria_id,
       p_brand AS categoria_nome, CAST(NULL AS VARCHAR) AS categoria_descricao,
       true AS categoria_ativa,
       {days_after('1995-01-01', "split_part(p_brand, '#', 2)")} AS categoria_criado_em
FROM part""",
    "dim_products": f"""WITH {PRODUCTS}
SELECT p_partkey AS produto_id, p_name AS produto_nome, p_type AS produto_descricao,
       categoria_id, categoria_nome, fornecedor_id, s_name AS fornecedor_nome,
       p_retailprice AS produto_preco, CAST(custo_cents AS DOUBLE) / 100 AS produto_custo,
       CAST(p_size AS DOUBLE) AS produto_peso, p_size AS produto_quantidade_estoque,
       p_size > 0 AS produto_em_estoque, true AS produto_ativo,
       {days_after('1995-01-01', 'p_partkey % 2400')} AS produto_criado_em
FROM part JOIN products ON produto_id = p_partkey LEFT JOIN supplier ON s_suppkey = fornecedor_id""",
    "dim_customers": f"""WITH {CUSTOMERS}
SELECT cliente_id, split_part(c_name, '#', 1) AS cliente_nome,
       split_part(c_name, '#', 2) AS cliente_sobrenome, cliente_nome_completo, cliente_email,
       CAST(NULL AS VARCHAR) AS cliente_telefone, CAST(NULL AS VARCHAR) AS cliente_cpf,
       {days_after('1950-01-01', 'c_custkey % 18000')} AS cliente_data_nascimento,
       CAST(2001 - year(DATE '1950-01-01' + CAST(c_custkey % 18000 AS INT)) AS INT) AS cliente_idade,
       CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS cliente_genero,
       {days_after('1995-01-01', 'c_custkey % 2400')} AS cliente_criado_em
FROM customer JOIN customers ON cliente_id = c_custkey""",
    "dim_addresses": f"""
SELECT c_custkey AS endereco_id, c_custkey AS cliente_id, CAST(NULL AS VARCHAR) AS endereco_cep,
       CAST(NULL AS VARCHAR) AS endereco_logradouro, CAST(NULL AS VARCHAR) AS endereco_numero,
       CAST(NULL AS VARCHAR) AS endereco_complemento, CAST(NULL AS VARCHAR) AS endereco_bairro,
       n_name AS endereco_cidade, r_name AS endereco_estado, true AS endereco_principal,
       {days_after('1995-01-01', 'c_custkey % 2400')} AS endereco_criado_em
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "dim_date": f"""
SELECT data, {DAY_PARTS}, CAST(isoyear(data) AS INT) AS ano_iso
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS data FROM orders) WHERE data IS NOT NULL""",
    "facts_sales": f"WITH {FACTS} SELECT {FACT_COLUMNS} FROM facts",
    "rejected_lines": """
SELECT CASE WHEN (l_quantity > 0) IS NOT TRUE THEN 'quantidade'
            WHEN (l_extendedprice > 0) IS NOT TRUE THEN 'subtotal'
            WHEN o_custkey IS NULL THEN 'dim_cliente_id'
            WHEN l_partkey IS NULL THEN 'dim_produto_id'
            ELSE 'aceita' END AS resultado, count(*) AS linhas
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""",
    "silver_run_totals": f"""WITH {FACTS}
SELECT count(*) AS total_records, {money_sum('total_venda')} AS total_value,
       CAST(sum(quantidade) AS BIGINT) AS total_items FROM facts""",
    "monthly_sales": _monthly("facts", "", "count(dim_cliente_id)"),
    "monthly_sales_by_order": _monthly("sales", f", {SALES}", "count(DISTINCT dim_cliente_id)"),
    "top_products": _top_products("total_venda"),
    "top_products_by_subtotal": _top_products("subtotal"),
    "vip_customers": _vip("facts", ""),
    "vip_customers_by_order": _vip("sales", f", {SALES}"),
    "category_performance": f"""WITH {FACTS}, {PRODUCTS}
SELECT categoria_id, categoria_nome, {money_sum('total_venda')} AS receita_categoria,
       CAST(sum(quantidade) AS BIGINT) AS itens_vendidos, count(*) AS numero_transacoes,
       {UNIT_PRICE_MEAN} AS preco_medio_categoria, count(dim_cliente_id) AS clientes_unicos
FROM facts JOIN products ON dim_produto_id = produto_id GROUP BY 1, 2""",
    "category_performance_by_subtotal": f"""WITH {FACTS}, {PRODUCTS}
SELECT categoria_id, categoria_nome, {money_sum('subtotal')} AS receita_categoria,
       CAST(sum(quantidade) AS BIGINT) AS itens_vendidos, count(*) AS numero_transacoes,
       {UNIT_PRICE_MEAN} AS preco_medio_categoria,
       count(DISTINCT dim_cliente_id) AS clientes_unicos
FROM facts JOIN products ON dim_produto_id = produto_id GROUP BY 1, 2""",
    "daily_sales": _daily("facts", ""),
    "daily_sales_by_order": _daily("sales", f", {SALES}"),
    "executive_summary": _summary("facts", "", "count(dim_cliente_id)"),
    "executive_summary_by_order": _summary("sales", f", {SALES}", "count(DISTINCT dim_cliente_id)"),
}
