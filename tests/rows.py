"""Hand-made bronze rows: name the columns that matter, the rest is filled in."""

import datetime as dt
from decimal import Decimal

from granary.schemas import BRONZE

DEFAULTS = {
    "vendas": {
        "cliente_id": 1, "endereco_entrega_id": 1, "subtotal": 10, "frete": 0, "total": 10,
        "status": "ok", "metodo_pagamento": "pix", "status_pagamento": "pago",
        "data_venda": dt.datetime(2025, 1, 10, 12),
    },
    "itens_venda": {
        "venda_id": 1, "produto_id": 1, "quantidade": 1, "preco_unitario": 10, "subtotal": 10,
    },
    "produtos": {"nome": "p", "categoria_id": 1, "fornecedor_id": 1, "preco": 10, "custo": 6, "quantidade_estoque": 5},
    "clientes": {"nome": "Ana", "sobrenome": "Silva", "email": "a@b.co"},
    "categorias": {"nome": "c"},
    "fornecedores": {"nome": "f"},
    "enderecos": {"cliente_id": 1},
}


def bronze(spark, table, *rows, **common):
    schema = BRONZE[table]
    money = {f.name for f in schema.fields if f.dataType.typeName() == "decimal"}

    def value(row, name):
        found = row.get(name, common.get(name, DEFAULTS[table].get(name)))
        return Decimal(str(found)) if name in money and found is not None else found

    filled = []
    for number, row in enumerate(rows, 1):
        row = {"id": number, **row}
        filled.append(tuple(value(row, name) for name in schema.fieldNames()))
    return spark.createDataFrame(filled, schema)


def values(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
