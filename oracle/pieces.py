"""Text shared by the statements."""

DEC = "DECIMAL(18,2)"


def cents(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


def money_sum(x: str) -> str:
    return f"CAST(sum(CAST({x} AS {DEC})) AS DOUBLE)"


def half_up(numerator: str, denominator: str) -> str:
    """Non-negative whole cents over a count, as money."""
    return (
        f"CAST((2 * CAST({numerator} AS HUGEINT) + {denominator}) // (2 * {denominator}) AS DOUBLE) / 100"
    )


def money_mean(x: str) -> str:
    return half_up(f"sum({cents(x)})", f"count({x})")


FACTS = f"""facts AS (
  SELECT o_orderkey AS venda_id,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   CAST(l_quantity AS INT), CAST(l_shipdate AS DATE)) AS item_venda_id,
         o_custkey AS dim_cliente_id, l_partkey AS dim_produto_id, o_custkey AS dim_endereco_id,
         CAST(o_orderdate AS DATE) AS dim_tempo_data,
         CAST(l_quantity AS INT) AS quantidade,
         CAST((2 * {cents('l_extendedprice')} + CAST(l_quantity AS BIGINT))
              // (2 * CAST(l_quantity AS BIGINT)) AS DOUBLE) / 100 AS preco_unitario,
         l_extendedprice AS subtotal, o_totalprice AS subtotal_venda, CAST(o_orderkey % 17 AS DOUBLE) * 0.5 AS frete,
         o_totalprice AS total_venda, o_orderstatus AS status_venda,
         o_orderpriority AS metodo_pagamento, o_orderstatus AS status_pagamento,
         o_orderdate AS data_venda,
         CAST(year(o_orderdate) AS INT) AS ano, CAST(month(o_orderdate) AS INT) AS mes,
         CAST(day(o_orderdate) AS INT) AS dia,
         l_shipdate AS data_envio, l_discount AS desconto, l_tax AS imposto
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  WHERE l_quantity > 0 AND l_extendedprice > 0 AND o_custkey IS NOT NULL AND l_partkey IS NOT NULL
)"""

SALES = """sales AS (
  SELECT venda_id, max(total_venda) AS total_venda, max(dim_cliente_id) AS dim_cliente_id,
         max(data_venda) AS data_venda, max(dim_tempo_data) AS dim_tempo_data,
         max(ano) AS ano, max(mes) AS mes, max(status_pagamento) AS status_pagamento,
         sum(quantidade) AS quantidade, count(*) AS linhas
  FROM facts GROUP BY venda_id
)"""

PRODUCTS = """products AS (
  SELECT p_partkey AS produto_id, p_name AS produto_nome,
         CAST(split_part(p_brand, '#', 2) AS BIGINT) AS categoria_id, p_brand AS categoria_nome,
         p_partkey % 128 AS fornecedor_id, p_size AS estoque,
         (3 * CAST(round(p_retailprice * 100) AS BIGINT) + 2) // 5 AS custo_cents
  FROM part
)"""

CUSTOMERS = """customers AS (
  SELECT c_custkey AS cliente_id, replace(c_name, '#', ' ') AS cliente_nome_completo,
         lower(split_part(c_name, '#', 1)) || '.' || split_part(c_name, '#', 2) || '@example.com'
           AS cliente_email
  FROM customer
)"""

DAY_PARTS = """CAST(year(data) AS INT) AS ano, CAST(month(data) AS INT) AS mes,
  CAST(day(data) AS INT) AS dia, CAST(dayofweek(data) + 1 AS INT) AS dia_semana,
  CAST(weekofyear(data) AS INT) AS semana_ano, CAST(quarter(data) AS INT) AS trimestre,
  monthname(data) AS mes_nome, dayname(data) AS dia_semana_nome,
  CASE WHEN dayofweek(data) IN (0, 6) THEN 'Final de Semana' ELSE 'Dia Útil' END AS tipo_dia"""

CALENDAR = f"""calendar AS (
  SELECT data, {DAY_PARTS}
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS data FROM orders) WHERE data IS NOT NULL
)"""


def days_after(start: str, days: str) -> str:
    return f"CAST(DATE '{start}' + CAST({days} AS INT) AS TIMESTAMP)"
