"""Analyses."""

from oracle.pieces import CALENDAR, FACTS, PRODUCTS, SALES, half_up, money_sum

HEAD = f"WITH {FACTS}, {SALES}"
BUYERS = f"""buyers AS (
  SELECT dim_cliente_id AS cliente_id, count(*) AS vendas,
         sum(CAST(total_venda AS DECIMAL(18,2))) AS receita,
         sum(CAST(round(total_venda * 100) AS BIGINT)) AS receita_cents,
         min(data_venda) AS primeira_venda, max(data_venda) AS ultima_venda
  FROM sales GROUP BY 1
)"""
PRODUCT_SALES = """sold AS (
  SELECT dim_produto_id AS produto_id, sum(quantidade) AS quantidade,
         sum(CAST(subtotal AS DECIMAL(18,2))) AS receita,
         sum(CAST(round(preco_unitario * 100) AS BIGINT) * quantidade) AS valor_cents,
         count(*) AS linhas
  FROM facts GROUP BY 1
)"""
MONTHS = """months AS (
  SELECT ano, mes, ano * 12 + mes AS n, sum(CAST(total_venda AS DECIMAL(18,2))) AS receita,
         sum(CAST(round(total_venda * 100) AS BIGINT)) AS cents
  FROM sales GROUP BY 1, 2
)"""


def _period(name: str, start: str) -> str:
    return f"""SELECT '{name}' AS periodo, CAST({start} AS DATE) AS inicio, count(*) AS vendas,
  {money_sum('total_venda')} AS receita, CAST(sum(quantidade) AS BIGINT) AS itens
FROM sales GROUP BY 2"""


def _segment(name: str, expr: str) -> str:
    return f"""SELECT '{name}' AS dimensao, {expr} AS grupo, count(*) AS clientes,
  CAST(sum(vendas) AS BIGINT) AS vendas, CAST(sum(receita) AS DOUBLE) AS receita
FROM people GROUP BY 2"""


def _status(name: str) -> str:
    return f"""CAST(sum(CAST(total_venda AS DECIMAL(18,2))) FILTER (WHERE status_pagamento = '{name}') AS DOUBLE)
  AS receita_{name.lower()}"""


def _score(column: str, descending: bool = False) -> str:
    above = " + ".join(f"CAST({column} > round(q_{column}[{i}], 6) AS INT)" for i in range(1, 5))
    return f"5 - ({above})" if descending else f"1 + {above}"


def _quintiles(column: str) -> str:
    return f"quantile_cont(CAST({column} AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS q_{column}"


def _rounded(micro_units: str) -> str:
    """Non-negative millionths to money, half up."""
    return f"CAST((2 * ({micro_units}) + 10000) // 20000 AS DOUBLE) / 100"


CENTS = "CAST(round(subtotal * 100) AS HUGEINT)"
DISCOUNT = "CAST(round(desconto * 100) AS HUGEINT)"
TAX = "CAST(round(imposto * 100) AS HUGEINT)"
GROSS_SUM = f"sum({CENTS} * 10000)"
DISCOUNT_SUM = f"sum({CENTS} * {DISCOUNT} * 100)"
TAX_SUM = f"sum({CENTS} * (100 - {DISCOUNT}) * {TAX})"

SQL = {
    "customer_category": f"""{HEAD}, {BUYERS}
SELECT cliente_id, vendas, CAST(receita AS DOUBLE) AS receita,
       CASE WHEN receita >= 3000000 THEN 'ouro' WHEN receita >= 1500000 THEN 'prata'
            ELSE 'bronze' END AS categoria_cliente FROM buyers""",
    "sales_by_period": f"{HEAD}\n"
    + "\nUNION ALL ".join(
        [
            _period("dia", "dim_tempo_data"),
            _period("semana", "date_trunc('week', dim_tempo_data)"),
            _period("mes", "date_trunc('month', dim_tempo_data)"),
            _period("ano", "date_trunc('year', dim_tempo_data)"),
        ]
    ),
    "ticket_by_customer": f"""{HEAD}, {BUYERS}
SELECT cliente_id, vendas, CAST(receita AS DOUBLE) AS receita,
       {half_up('receita_cents', 'vendas')} AS ticket_medio FROM buyers""",
    "ticket_by_category": f"""WITH {FACTS}, {PRODUCTS}
SELECT categoria_id, categoria_nome, count(DISTINCT venda_id) AS vendas,
       {money_sum('subtotal')} AS receita,
       {half_up('sum(CAST(round(subtotal * 100) AS BIGINT))', 'count(DISTINCT venda_id)')} AS ticket_medio
FROM facts JOIN products ON dim_produto_id = produto_id GROUP BY 1, 2""",
    "conversion_daily": """
SELECT data, visitantes, compradores,
       CASE WHEN visitantes > 0 THEN compradores::DOUBLE / visitantes END AS taxa_conversao
FROM (SELECT CAST(ts AS DATE) AS data,
             count(DISTINCT user_id) FILTER (WHERE event_type = 'view') AS visitantes,
             count(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS compradores
      FROM events WHERE user_id IS NOT NULL GROUP BY 1)""",
    "seasonality": f"""{HEAD}, {MONTHS}
SELECT mes, count(*) AS meses, {half_up('sum(cents)', 'count(*)')} AS receita_media,
       CAST(sum(receita) AS DOUBLE) / count(*)
         / (SELECT CAST(sum(receita) AS DOUBLE) / count(*) FROM months) AS indice_sazonal
FROM months GROUP BY 1""",
    "sales_trend": f"""{HEAD}, {MONTHS}
SELECT m.ano, m.mes, CAST(m.receita AS DOUBLE) AS receita,
       (m.receita::DOUBLE - b.receita::DOUBLE) / b.receita::DOUBLE AS variacao_mensal,
       (m.receita::DOUBLE - y.receita::DOUBLE) / y.receita::DOUBLE AS variacao_anual,
       (SELECT {half_up('sum(t.cents)', 'count(*)')} FROM months t WHERE t.n BETWEEN m.n - 2 AND m.n)
         AS media_movel_3m
FROM months m LEFT JOIN months b ON b.n = m.n - 1 LEFT JOIN months y ON y.n = m.n - 12""",
    "rfm_segments": f"""{HEAD}, {BUYERS}, base AS (
  SELECT cliente_id, CAST(DATE '2001-12-31' - CAST(ultima_venda AS DATE) AS INT) AS recencia,
         vendas AS frequencia, CAST(receita AS DOUBLE) AS valor FROM buyers
), limits AS (
  SELECT {_quintiles('recencia')}, {_quintiles('frequencia')}, {_quintiles('valor')} FROM base
), scored AS (
  SELECT cliente_id, recencia, frequencia, valor,
         CAST({_score('recencia', True)} AS INT) AS nota_recencia,
         CAST({_score('frequencia')} AS INT) AS nota_frequencia,
         CAST({_score('valor')} AS INT) AS nota_valor
  FROM base, limits
)
SELECT *, CASE WHEN nota_recencia >= 4 AND nota_frequencia >= 4 AND nota_valor >= 4 THEN 'campeoes'
               WHEN nota_frequencia >= 4 AND nota_recencia >= 3 THEN 'fieis'
               WHEN nota_recencia <= 2 AND nota_frequencia >= 3 THEN 'em_risco'
               WHEN nota_recencia >= 4 AND nota_frequencia <= 2 THEN 'novos'
               WHEN nota_recencia <= 2 THEN 'perdidos' ELSE 'regulares' END AS segmento_rfm
FROM scored""",
    "customer_ltv": f"""{HEAD}, {BUYERS}, active AS (
  SELECT *, CAST(year(ultima_venda) * 12 + month(ultima_venda)
             - year(primeira_venda) * 12 - month(primeira_venda) + 1 AS INT) AS meses_ativos
  FROM buyers
)
SELECT cliente_id, vendas, {half_up('receita_cents', 'vendas')} AS valor_medio, meses_ativos,
       vendas::DOUBLE / meses_ativos AS vendas_por_mes, CAST(receita AS DOUBLE) AS valor_historico,
       {half_up('receita_cents * 12', 'meses_ativos')} AS valor_projetado FROM active""",
    "sales_by_segment": f"""{HEAD}, {BUYERS}, people AS (
  SELECT vendas, receita, c_mktsegment, r_name, c_custkey % 2 AS odd,
         2001 - year(DATE '1950-01-01' + CAST(c_custkey % 18000 AS INT)) AS age
  FROM buyers JOIN customer ON cliente_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
)\n"""
    + "\nUNION ALL ".join(
        [
            _segment("segmento", "c_mktsegment"),
            _segment("regiao", "r_name"),
            _segment("genero", "CASE WHEN odd = 0 THEN 'F' ELSE 'M' END"),
            _segment(
                "faixa_etaria",
                "CASE WHEN age < 25 THEN 'ate 24' WHEN age < 35 THEN '25 a 34' "
                "WHEN age < 45 THEN '35 a 44' WHEN age < 55 THEN '45 a 54' ELSE '55 ou mais' END",
            ),
        ]
    ),
    "rank_in_category": f"""WITH {FACTS}, {PRODUCTS}, {PRODUCT_SALES}
SELECT categoria_id, categoria_nome, CAST(posicao AS INT) AS posicao, produto_id, produto_nome,
       CAST(quantidade AS BIGINT) AS quantidade, CAST(receita AS DOUBLE) AS receita
FROM (SELECT *, row_number() OVER (PARTITION BY categoria_id ORDER BY quantidade DESC, produto_id) AS posicao
      FROM sold JOIN products USING (produto_id)) WHERE posicao <= 10""",
    "margin_by_category": f"""WITH {FACTS}, {PRODUCTS}, {PRODUCT_SALES}, summed AS (
  SELECT categoria_id, categoria_nome, CAST(sum(valor_cents) AS HUGEINT) AS receita,
         CAST(sum(custo_cents * quantidade) AS HUGEINT) AS custo
  FROM sold JOIN products USING (produto_id) GROUP BY 1, 2
)
SELECT categoria_id, categoria_nome, CAST(receita AS DOUBLE) / 100 AS receita,
       CAST(custo AS DOUBLE) / 100 AS custo, CAST(receita - custo AS DOUBLE) / 100 AS margem,
       (CAST(receita - custo AS DOUBLE) / 100) / (CAST(receita AS DOUBLE) / 100) AS margem_relativa
FROM summed""",
    "stock_turnover": f"""WITH {FACTS}, {PRODUCTS}, {PRODUCT_SALES}, {CALENDAR}, days AS (
  SELECT max(data) - min(data) + 1 AS d FROM calendar
)
SELECT produto_id, estoque, CAST(coalesce(quantidade, 0) AS BIGINT) AS vendido,
       CASE WHEN estoque <> 0 THEN CAST(coalesce(quantidade, 0) AS DOUBLE) / estoque END AS giro,
       CASE WHEN quantidade <> 0 THEN CAST(estoque AS DOUBLE) * d / CAST(quantidade AS DOUBLE) END
         AS dias_cobertura
FROM products LEFT JOIN sold USING (produto_id), days""",
    "supplier_metrics": f"""WITH {FACTS}, {PRODUCTS}, {PRODUCT_SALES}, per_supplier AS (
  SELECT s_suppkey, fornecedor_id, s_name AS fornecedor_nome, sum(receita) AS receita,
         CAST(sum(linhas) AS BIGINT) AS linhas, count(*) AS produtos
  FROM sold JOIN products USING (produto_id) LEFT JOIN supplier ON s_suppkey = fornecedor_id
  GROUP BY 1, 2, 3
)
SELECT fornecedor_id, fornecedor_nome, CAST(receita AS DOUBLE) AS receita, linhas, produtos,
       CAST(receita AS DOUBLE) / (SELECT CAST(sum(receita) AS DOUBLE) FROM per_supplier) AS participacao
FROM per_supplier""",
    "regional_rollup": f"""{HEAD}
SELECT r_name AS estado, n_name AS cidade, CAST(grouping_id(r_name, n_name) AS INT) AS nivel,
       count(*) AS vendas, {money_sum('total_venda')} AS receita
FROM sales JOIN customer ON dim_cliente_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name)""",
    "shipping_days": f"""WITH {FACTS}, timed AS (
  SELECT ano, CAST(data_envio AS DATE) - dim_tempo_data AS dias FROM facts
), freight AS (
  SELECT ano, round(sum(frete) / sum(total_venda), 9) AS participacao_frete
  FROM (SELECT DISTINCT ano, venda_id, frete, total_venda FROM facts) GROUP BY 1
)
SELECT ano, count(*) FILTER (WHERE dias >= 0) AS envios, count(*) FILTER (WHERE dias < 0) AS invalidos,
       {half_up('sum(dias * 100) FILTER (WHERE dias >= 0)', 'count(*) FILTER (WHERE dias >= 0)')} AS dias_medio,
       round(CAST(quantile_cont(dias, 0.5) FILTER (WHERE dias >= 0) AS DOUBLE), 6) AS dias_mediana,
       round(CAST(quantile_cont(dias, 0.9) FILTER (WHERE dias >= 0) AS DOUBLE), 6) AS dias_p90,
       any_value(participacao_frete) AS participacao_frete
FROM timed JOIN freight USING (ano) GROUP BY 1""",
    "financials": f"""WITH {FACTS}
SELECT ano, mes, {_rounded(GROSS_SUM)} AS receita_bruta, {_rounded(DISCOUNT_SUM)} AS descontos,
       {_rounded(TAX_SUM)} AS impostos, {_rounded(f'{GROSS_SUM} - {DISCOUNT_SUM}')} AS receita_liquida
FROM facts GROUP BY 1, 2""",
    "payment_status_pivot": f"""{HEAD}
SELECT ano, mes, {_status('F')}, {_status('O')}, {_status('P')} FROM sales GROUP BY 1, 2""",
}
