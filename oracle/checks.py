"""Cleaning and checking."""

EMAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)*\\.[A-Za-z]{2,}"


def _orphans(name: str, child: str, key: str, parent: str) -> str:
    return f"""SELECT '{name}' AS referencia, count(*) AS linhas_orfas,
  count(DISTINCT k) AS chaves_orfas
FROM (SELECT {key} AS k FROM {child}) WHERE k IS NOT NULL AND k NOT IN ({parent})"""


def _nulls(table: str, source: str, columns: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{table}' AS tabela, '{name}' AS coluna,
  count(*) FILTER (WHERE {expr} IS NULL) AS nulos, count(*) AS linhas FROM {source}"""
        for name, expr in columns.items()
    )


def _conversion(name: str, kind: str, expr: str, source: str, duck: str) -> str:
    return f"""SELECT '{name}' AS coluna, '{kind}' AS tipo, count(*) AS linhas,
  count(*) - count(x) AS nulos, count(try_cast(x AS {duck})) AS convertidos,
  count(x) - count(try_cast(x AS {duck})) AS recusados
FROM (SELECT {expr} AS x FROM {source})"""


SQL = {
    "dedup_latest": """
SELECT * EXCLUDE (position) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
             l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
             l_linestatus DESC) AS position
  FROM lineitem) WHERE position = 1""",
    "orphan_report": "\nUNION ALL ".join(
        [
            _orphans("itens_venda.venda_id", "lineitem", "l_orderkey", "SELECT o_orderkey FROM orders"),
            _orphans("itens_venda.produto_id", "lineitem", "l_partkey", "SELECT p_partkey FROM part"),
            _orphans("vendas.cliente_id", "orders", "o_custkey", "SELECT c_custkey FROM customer"),
            _orphans(
                "vendas.endereco_entrega_id", "orders", "o_custkey", "SELECT c_custkey FROM customer"
            ),
            _orphans("produtos.categoria_id", "part", "p_brand", "SELECT p_brand FROM part"),
            _orphans("produtos.fornecedor_id", "part", "p_partkey % 128", "SELECT s_suppkey FROM supplier"),
        ]
    ),
    "typed_columns": "\nUNION ALL ".join(
        [
            _conversion("prioridade", "int", "split_part(o_orderpriority, '-', 1)", "orders", "INT"),
            _conversion("situacao", "double", "o_orderstatus", "orders", "DOUBLE"),
            _conversion(
                "momento", "timestamp", "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')", "orders", "TIMESTAMP"
            ),
            _conversion("pagina", "bigint", "split_part(url, '/', -1)", "pages", "BIGINT"),
        ]
    ),
    "rule_report": """
WITH people AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 11 <> 0 THEN c_custkey END AS id FROM customer
), goods AS (SELECT p_partkey AS k, p_retailprice AS price, p_size AS stock FROM part),
rules AS (
  SELECT 'clientes' AS tabela, 'id_ausente' AS regra, true AS recusa, count(*) AS linhas, count(*) FILTER (id IS NULL) AS violacoes FROM people
  UNION ALL SELECT 'clientes', 'email_invalido', false, count(*), count(*) FILTER (k % 5 = 0) FROM people
  UNION ALL SELECT 'clientes', 'cpf_invalido', false, count(*), count(*) FILTER (k % 3 = 1) FROM people
  UNION ALL SELECT 'produtos', 'id_ausente', true, count(*), count(*) FILTER (k IS NULL) FROM goods
  UNION ALL SELECT 'produtos', 'categoria_id_ausente', false, count(*), count(*) FILTER (k % 9 = 0) FROM goods
  UNION ALL SELECT 'produtos', 'preco_negativo', false, count(*), count(*) FILTER (k % 4 = 0 AND price > 0) FROM goods
  UNION ALL SELECT 'produtos', 'estoque_negativo', false, count(*), count(*) FILTER (stock < 0) FROM goods
) SELECT * FROM rules""",
    "refused_lines": """
WITH joined AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT), CAST(l_shipdate AS DATE)) AS item_venda_id,
         l_orderkey % 5 = 0 AS no_quantity, l_partkey % 10 = 0 AS no_product, o_orderkey % 13 = 0 AS no_customer
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)
SELECT item_venda_id, concat_ws(',', CASE WHEN no_quantity THEN 'quantidade_invalido' END,
  CASE WHEN no_customer THEN 'dim_cliente_id_ausente' END, CASE WHEN no_product THEN 'dim_produto_id_ausente' END) AS motivos
FROM joined WHERE no_quantity OR no_product OR no_customer""",
    "clean_text": r"""
SELECT doc_id, trim(regexp_replace(
  regexp_replace(text, '[\x00-\x08\x0E-\x1F\x7F]', '', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g'), ' ') AS texto
FROM documents""",
    "required_fields": "\nUNION ALL ".join(
        [
            _nulls(
                "vendas", "orders",
                {"id": "o_orderkey", "cliente_id": "o_custkey", "total": "o_totalprice", "data_venda": "o_orderdate"},
            ),
            _nulls(
                "itens_venda", "lineitem",
                {"venda_id": "l_orderkey", "produto_id": "l_partkey", "quantidade": "l_quantity", "subtotal": "l_extendedprice"},
            ),
            _nulls(
                "clientes", "customer",
                {"id": "c_custkey", "nome": "c_name", "email": "c_name", "cpf": "CAST(NULL AS VARCHAR)"},
            ),
        ]
    ),
    "email_check": f"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '{EMAIL}')) AS INT) AS enderecos,
       regexp_full_match(text, '{EMAIL}') AS texto_e_email
FROM documents WHERE regexp_matches(text, '{EMAIL}')""",
    "outliers_iqr": """WITH quartiles AS (
  SELECT event_type, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.75), 6) AS q3
  FROM events GROUP BY 1
), fences AS (
  SELECT event_type, round(q1 - (q3 - q1) * 1.5, 6) AS low, round(q3 + (q3 - q1) * 1.5, 6) AS high
  FROM quartiles
)
SELECT event_id, e.event_type, value, low AS limite_inferior, high AS limite_superior,
       value < low OR value > high AS atipico, least(greatest(value, low), high) AS valor_ajustado
FROM events e LEFT JOIN fences f ON e.event_type = f.event_type""",
}
