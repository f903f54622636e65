"""Reading, writing and incremental loading."""

from oracle.analyses import SQL as ANALYSES
from oracle.lake_tables import FACT_COLUMNS
from oracle.lake_tables import SQL as TABLES
from oracle.pieces import FACTS, PRODUCTS, money_sum

SALES_COLUMNS = """SELECT o_orderkey AS id, o_custkey AS cliente_id,
  o_custkey AS endereco_entrega_id, o_totalprice AS subtotal, CAST(o_orderkey % 17 AS DOUBLE) * 0.5 AS frete,
  o_totalprice AS total, o_orderstatus AS status, o_orderpriority AS metodo_pagamento,
  o_orderstatus AS status_pagamento, o_orderdate AS data_venda FROM orders"""

# The mark is the last sale up to 30 June 1999; batches start three days earlier.
MARK = "(SELECT max(o_orderdate) FROM orders WHERE o_orderdate <= TIMESTAMP '1999-06-30')"


def _extracted(table: str, rows: str, source: str) -> str:
    return f"""SELECT '{table}' AS tabela, '1996-03-15' AS data_extracao, count(*) AS registros,
  CASE WHEN count(*) = 0 THEN 'empty' ELSE 'success' END AS situacao FROM {source} {rows}"""


def _created(days: str) -> str:
    return f"WHERE DATE '1995-01-01' + CAST({days} AS INT) = DATE '1996-03-15'"

def _stored(name: str, query: str, keys: tuple[str, ...], count: str, amount: str) -> str:
    key = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"""SELECT '{name}' AS analise, concat_ws('|', {key}) AS chave, CAST({count} AS BIGINT) AS vendas,
  CAST({amount} AS DOUBLE) AS valor FROM ({ANALYSES[query]})"""


SQL = {
    "extract_for_date": f"""{SALES_COLUMNS}
WHERE o_orderdate >= TIMESTAMP '1996-03-15' AND o_orderdate < TIMESTAMP '1996-03-16'""",
    "high_water_mark": f"""WITH {FACTS}
SELECT coalesce(max(data_venda), TIMESTAMP '1900-01-01') AS max_date FROM facts""",
    "incremental_sales": f"""WITH {FACTS}
SELECT {FACT_COLUMNS} FROM facts WHERE data_venda >= {MARK} - INTERVAL 3 DAY""",
    "recent_period": f"""SELECT * FROM ({TABLES['monthly_sales']})
WHERE ano >= 1999""",
    "upsert_facts": f"WITH {FACTS} SELECT {FACT_COLUMNS} FROM facts",
    "incremental_equals_full": TABLES["facts_sales"],
    "deleted_sales": f"WITH {FACTS} SELECT {FACT_COLUMNS} FROM facts WHERE ano <> 2000 OR venda_id % 3 <> 0",
    "gold_from_stored_totals": f"WITH {FACTS}" + " UNION ALL ".join(
        f"""
SELECT '{kind}' AS chave, CAST({column} AS VARCHAR) AS valor, count(*) AS linhas,
  CAST(sum(quantidade) AS BIGINT) AS itens, {money_sum('total_venda')} AS receita
FROM facts GROUP BY 2"""
        for kind, column in (("dia", "CAST(data_venda AS DATE)"), ("produto", "dim_produto_id"), ("cliente", "dim_cliente_id"))
    ),
    "analyses_from_stored_totals": "\nUNION ALL ".join(
        [
            _stored("vendas_por_periodo", "sales_by_period", ("periodo", "inicio"), "vendas", "receita"),
            _stored("valor_vida_clientes", "customer_ltv", ("cliente_id", "meses_ativos"), "vendas", "valor_projetado"),
            _stored("ticket_categorias", "ticket_by_category", ("categoria_id", "categoria_nome"), "vendas", "ticket_medio"),
            _stored("margem_categorias", "margin_by_category", ("categoria_id",), "NULL", "margem"),
            _stored("vendas_por_regiao", "regional_rollup", ("nivel", "estado", "cidade"), "vendas", "receita"),
            _stored("prazos_envio", "shipping_days", ("ano",), "envios", "participacao_frete"),
            _stored("resultado_financeiro", "financials", ("ano", "mes"), "NULL", "receita_liquida"),
        ]
    ),
    "read_bronze": SALES_COLUMNS.replace(
        " FROM orders", ", CASE WHEN o_orderkey % 2 <> 0 THEN 'web' END AS canal FROM orders"
    ),
    "bronze_roundtrip": SALES_COLUMNS,
    "silver_roundtrip": TABLES["facts_sales"],
    "gold_roundtrip": TABLES["monthly_sales"],
    "gold_row_counts": f"""
SELECT 'facts_vendas' AS tabela, count(*) AS registros FROM ({TABLES['facts_sales']})
UNION ALL SELECT 'vendas_mensais', count(*) FROM ({TABLES['monthly_sales']})
UNION ALL SELECT 'top_produtos', count(*) FROM ({TABLES['top_products']})
UNION ALL SELECT 'clientes_vip', count(*) FROM ({TABLES['vip_customers']})
UNION ALL SELECT 'performance_categorias', count(*) FROM ({TABLES['category_performance']})
UNION ALL SELECT 'vendas_diarias', count(*) FROM ({TABLES['daily_sales']})
UNION ALL SELECT 'resumo_executivo', count(*) FROM ({TABLES['executive_summary']})""",
    "adhoc_sql": f"""WITH {FACTS}, {PRODUCTS}
SELECT categoria_nome, ano, count(DISTINCT venda_id) AS vendas, {money_sum('subtotal')} AS receita
FROM facts JOIN products ON dim_produto_id = produto_id
WHERE status_venda <> 'P' GROUP BY 1, 2""",
    "nanos_to_timestamp": "SELECT event_id, ts FROM events",
    "schema_report": """
SELECT table_name AS tabela, column_name AS coluna,
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
                      WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
                      WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>'
                      ELSE lower(data_type) END AS tipo,
       CASE WHEN table_name <> 'orders' OR column_name = 'o_orderpriority' THEN 'added'
            WHEN column_name = 'o_totalprice' THEN 'retyped' ELSE 'declared' END AS situacao
FROM information_schema.columns
WHERE table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem',
  'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations')
UNION ALL SELECT 'orders', 'o_comment', 'string', 'removed'""",
    "extract_report": "\nUNION ALL ".join(
        [
            _extracted("vendas", "WHERE CAST(o_orderdate AS DATE) = DATE '1996-03-15'", "orders"),
            _extracted("produtos", _created("p_partkey % 2400"), "part"),
            _extracted("itens_venda", "", "lineitem"),
            _extracted("clientes", _created("c_custkey % 2400"), "customer"),
            _extracted(
                "categorias", _created("split_part(p_brand, '#', 2)"),
                "(SELECT DISTINCT p_brand FROM part)",
            ),
            _extracted("fornecedores", _created("s_suppkey % 2400"), "supplier"),
            _extracted("enderecos", _created("c_custkey % 2400"), "customer"),
        ]
    ),
}
