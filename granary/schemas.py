"""Declared schemas of the bronze, silver, gold and report tables."""

from __future__ import annotations

from pyspark.sql import types as T

LONG = T.LongType()
INT = T.IntegerType()
DOUBLE = T.DoubleType()
TEXT = T.StringType()
FLAG = T.BooleanType()
DATE = T.DateType()
TIME = T.TimestampType()
MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(28, 2)


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Table and column names of the data model.
BRONZE = {
    "vendas": struct(
        ("id", LONG), ("cliente_id", LONG), ("endereco_entrega_id", LONG),
        ("subtotal", MONEY), ("frete", MONEY), ("total", MONEY),
        ("status", TEXT), ("metodo_pagamento", TEXT), ("status_pagamento", TEXT),
        ("data_venda", TIME),
    ),
    "itens_venda": struct(
        ("id", LONG), ("venda_id", LONG), ("produto_id", LONG),
        ("quantidade", INT), ("preco_unitario", MONEY), ("subtotal", MONEY),
    ),
    "produtos": struct(
        ("id", LONG), ("nome", TEXT), ("descricao", TEXT), ("categoria_id", LONG),
        ("fornecedor_id", LONG), ("preco", MONEY), ("custo", MONEY), ("peso", DOUBLE),
        ("quantidade_estoque", INT), ("em_estoque", FLAG), ("ativo", FLAG), ("criado_em", TIME),
    ),
    "clientes": struct(
        ("id", LONG), ("nome", TEXT), ("sobrenome", TEXT), ("email", TEXT), ("telefone", TEXT),
        ("cpf", TEXT), ("data_nascimento", TIME), ("genero", TEXT), ("criado_em", TIME),
    ),
    "categorias": struct(
        ("id", LONG), ("nome", TEXT), ("descricao", TEXT), ("ativa", FLAG), ("criado_em", TIME),
    ),
    "fornecedores": struct(
        ("id", LONG), ("nome", TEXT), ("email", TEXT), ("telefone", TEXT), ("cnpj", TEXT),
        ("ativo", FLAG), ("criado_em", TIME),
    ),
    "enderecos": struct(
        ("id", LONG), ("cliente_id", LONG), ("cep", TEXT), ("logradouro", TEXT), ("numero", TEXT),
        ("complemento", TEXT), ("bairro", TEXT), ("cidade", TEXT), ("estado", TEXT),
        ("endereco_principal", FLAG), ("criado_em", TIME),
    ),
}

# Columns that may arrive as nanoseconds, as dates or as timestamps.
TIMESTAMP_COLUMNS = ("criado_em", "atualizado_em", "data_venda", "data_nascimento")

_SILVER_METADATA = (("silver_created_at", TIME), ("silver_execution_date", TEXT), ("triggered_by", TEXT))
_GOLD_METADATA = (("gold_created_at", TIME), ("gold_execution_date", TEXT), ("triggered_by", TEXT))

SILVER = {
    "dim_fornecedores": struct(
        ("fornecedor_id", LONG), ("fornecedor_nome", TEXT), ("fornecedor_email", TEXT),
        ("fornecedor_telefone", TEXT), ("fornecedor_cnpj", TEXT), ("fornecedor_ativo", FLAG),
        ("fornecedor_criado_em", TIME), *_SILVER_METADATA,
    ),
    "dim_categorias": struct(
        ("categoria_id", LONG), ("categoria_nome", TEXT), ("categoria_descricao", TEXT),
        ("categoria_ativa", FLAG), ("categoria_criado_em", TIME), *_SILVER_METADATA,
    ),
    "dim_produtos": struct(
        ("produto_id", LONG), ("produto_nome", TEXT), ("produto_descricao", TEXT),
        ("categoria_id", LONG), ("categoria_nome", TEXT), ("fornecedor_id", LONG),
        ("fornecedor_nome", TEXT), ("produto_preco", MONEY), ("produto_custo", MONEY),
        ("produto_peso", DOUBLE), ("produto_quantidade_estoque", INT),
        ("produto_em_estoque", FLAG), ("produto_ativo", FLAG), ("produto_criado_em", TIME),
        *_SILVER_METADATA,
    ),
    "dim_clientes": struct(
        ("cliente_id", LONG), ("cliente_nome", TEXT), ("cliente_sobrenome", TEXT),
        ("cliente_nome_completo", TEXT), ("cliente_email", TEXT), ("cliente_telefone", TEXT),
        ("cliente_cpf", TEXT), ("cliente_data_nascimento", TIME), ("cliente_idade", INT),
        ("cliente_genero", TEXT), ("cliente_criado_em", TIME), *_SILVER_METADATA,
    ),
    "dim_enderecos": struct(
        ("endereco_id", LONG), ("cliente_id", LONG), ("endereco_cep", TEXT),
        ("endereco_logradouro", TEXT), ("endereco_numero", TEXT), ("endereco_complemento", TEXT),
        ("endereco_bairro", TEXT), ("endereco_cidade", TEXT), ("endereco_estado", TEXT),
        ("endereco_principal", FLAG), ("endereco_criado_em", TIME), *_SILVER_METADATA,
    ),
    "dim_tempo": struct(
        ("data", DATE), ("ano", INT), ("mes", INT), ("dia", INT), ("dia_semana", INT),
        ("semana_ano", INT), ("trimestre", INT), ("mes_nome", TEXT), ("dia_semana_nome", TEXT),
        ("tipo_dia", TEXT), *_SILVER_METADATA,
    ),
    "facts_vendas": struct(
        ("venda_id", LONG), ("item_venda_id", LONG), ("dim_cliente_id", LONG),
        ("dim_produto_id", LONG), ("dim_endereco_id", LONG), ("dim_tempo_data", DATE),
        ("quantidade", INT), ("preco_unitario", MONEY), ("subtotal", MONEY),
        ("subtotal_venda", MONEY), ("frete", MONEY), ("total_venda", MONEY),
        ("status_venda", TEXT), ("metodo_pagamento", TEXT), ("status_pagamento", TEXT),
        ("data_venda", TIME), ("ano", INT), ("mes", INT), ("dia", INT), *_SILVER_METADATA,
    ),
}

# Rows that break a rule, of any table.
BROKEN = T.StructType([
    T.StructField("tabela", TEXT), T.StructField("chave", TEXT), T.StructField("motivos", T.ArrayType(TEXT)),
    T.StructField("recusada", FLAG), T.StructField("linha", TEXT),
])

GOLD = {
    "vendas_mensais": struct(
        ("ano", INT), ("mes", INT), ("total_vendas", LONG), ("receita_total", MONEY_SUM),
        ("itens_vendidos", LONG), ("ticket_medio", MONEY), ("clientes_unicos", LONG),
        *_GOLD_METADATA,
    ),
    "top_produtos": struct(
        ("produto_id", LONG), ("produto_nome", TEXT), ("categoria_nome", TEXT),
        ("quantidade_vendida", LONG), ("receita_produto", MONEY_SUM), ("numero_vendas", LONG),
        ("preco_medio", MONEY), *_GOLD_METADATA,
    ),
    "clientes_vip": struct(
        ("cliente_id", LONG), ("cliente_nome_completo", TEXT), ("cliente_email", TEXT),
        ("valor_total_compras", MONEY_SUM), ("numero_compras", LONG),
        ("ticket_medio_cliente", MONEY), ("ultima_compra", TIME), ("primeira_compra", TIME),
        *_GOLD_METADATA,
    ),
    "performance_categorias": struct(
        ("categoria_id", LONG), ("categoria_nome", TEXT), ("receita_categoria", MONEY_SUM),
        ("itens_vendidos", LONG), ("numero_transacoes", LONG), ("preco_medio_categoria", MONEY),
        ("clientes_unicos", LONG), *_GOLD_METADATA,
    ),
    "vendas_diarias": struct(
        ("data", DATE), ("ano", INT), ("mes", INT), ("dia", INT), ("dia_semana_nome", TEXT),
        ("tipo_dia", TEXT), ("vendas_dia", LONG), ("receita_dia", MONEY_SUM), ("itens_dia", LONG),
        ("ticket_medio_dia", MONEY), *_GOLD_METADATA,
    ),
    "resumo_executivo": struct(
        ("total_transacoes", LONG), ("receita_total_periodo", MONEY_SUM),
        ("total_itens_vendidos", LONG), ("ticket_medio_geral", MONEY), ("total_clientes", LONG),
        ("data_ultima_venda", TIME), ("data_primeira_venda", TIME), ("periodo_analise", TEXT),
        *_GOLD_METADATA,
    ),
}

PARTITION_KEYS = {
    "dim_tempo": ("ano", "mes"),
    "facts_vendas": ("ano", "mes", "dia"),
    "vendas_mensais": ("ano", "mes"),
    "vendas_diarias": ("ano", "mes"),
    "_execution_reports": ("execution_date",),
    "_gold_execution_reports": ("execution_date",),
    "_manifest": ("execution_date",),
}

REPORTS = {
    "_execution_reports": struct(
        ("execution_date", TEXT), ("triggered_by", TEXT), ("is_incremental", FLAG),
        ("total_records", LONG), ("total_value", DOUBLE), ("total_items", LONG),
        ("last_processed_timestamp", TEXT), ("processed_at", TEXT),
    ),
    "_gold_execution_reports": struct(
        ("execution_date", TEXT), ("triggered_by", TEXT), ("is_incremental", FLAG),
        ("total_gold_records", LONG), ("source_facts_records", LONG), ("processed_at", TEXT),
    ),
    "_extract_report": struct(
        ("tabela", TEXT), ("data_extracao", TEXT), ("registros", LONG), ("situacao", TEXT),
        ("caminho", TEXT), ("erro", TEXT), ("tamanho_mb", DOUBLE),
    ),
    "_manifest": struct(
        ("execution_date", TEXT), ("tabela", TEXT), ("caminho", TEXT), ("registros", LONG),
        ("tipo", TEXT), ("formato", TEXT), ("compressao", TEXT), ("arquivos", LONG),
        ("tamanho_mb", DOUBLE),
    ),
}
# End of fixed values.
