"""Presents the generated test tables as bronze tables.

Only this module knows the test names. Columns the test tables do not have get
stand-in values; those show the shape of the data and mean nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.scalars import integer_quotient
from granary.schemas import MONEY


def _days_after(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int")).cast("timestamp_ntz")


def _money(name: str) -> Column:
    return F.col(name).cast(MONEY)


class Testbed:
    """Lazy access to the tables of one scale folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def bronze(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def vendas(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("cliente_id"),
            F.col("o_custkey").alias("endereco_entrega_id"),
            _money("o_totalprice").alias("subtotal"),
            ((F.col("o_orderkey") % 17) * F.lit("0.50").cast(MONEY)).cast(MONEY).alias("frete"),
            _money("o_totalprice").alias("total"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("metodo_pagamento"),
            F.col("o_orderstatus").alias("status_pagamento"),
            F.col("o_orderdate").alias("data_venda"),
        )

    def itens_venda(self) -> DataFrame:
        """Order lines. (order, line number) repeats, so the id needs six columns.

        ``data_envio``, ``desconto`` and ``imposto`` are extra source columns
        that only the logistics and financial reports read.
        """
        quantity = F.col("l_quantity").cast("int")
        price = _money("l_extendedprice")
        return self.raw("lineitem").select(
            F.concat_ws(
                "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                quantity, F.col("l_shipdate").cast("date"),
            ).alias("id"),
            F.col("l_orderkey").alias("venda_id"),
            F.col("l_partkey").alias("produto_id"),
            quantity.alias("quantidade"),
            _unit_price(F.col("l_extendedprice"), quantity).alias("preco_unitario"),
            price.alias("subtotal"),
            F.col("l_shipdate").alias("data_envio"),
            F.col("l_discount").cast("decimal(4,2)").alias("desconto"),
            F.col("l_tax").cast("decimal(4,2)").alias("imposto"),
        )

    def produtos(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.raw("part").select(
            key.alias("id"),
            F.col("p_name").alias("nome"),
            F.col("p_type").alias("descricao"),
            _brand_number().alias("categoria_id"),
            (key % 128).alias("fornecedor_id"),
            _money("p_retailprice").alias("preco"),
            F.round(_money("p_retailprice") * F.lit("0.6").cast("decimal(2,1)"), 2).cast(MONEY).alias("custo"),
            F.col("p_size").cast("double").alias("peso"),
            F.col("p_size").alias("quantidade_estoque"),
            (F.col("p_size") > 0).alias("em_estoque"),
            F.lit(True).alias("ativo"),
            _days_after("1995-01-01", key % 2400).alias("criado_em"),
        )

    def categorias(self) -> DataFrame:
        number = _brand_number()
        return self.raw("part").select("p_brand").distinct().select(
            number.alias("id"),
            F.col("p_brand").alias("nome"),
            F.lit(None).cast("string").alias("descricao"),
            F.lit(True).alias("ativa"),
            _days_after("1995-01-01", number).alias("criado_em"),
        )

    def clientes(self) -> DataFrame:
        """``segmento`` is an extra source column for the demographic report."""
        key = F.col("c_custkey")
        name = F.substring_index("c_name", "#", 1)
        surname = F.substring_index("c_name", "#", -1)
        return self.raw("customer").select(
            key.alias("id"),
            name.alias("nome"),
            surname.alias("sobrenome"),
            F.concat(F.lower(name), F.lit("."), surname, F.lit("@example.com")).alias("email"),
            F.lit(None).cast("string").alias("telefone"),
            F.lit(None).cast("string").alias("cpf"),
            _days_after("1950-01-01", key % 18000).alias("data_nascimento"),
            F.when(key % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("genero"),
            _days_after("1995-01-01", key % 2400).alias("criado_em"),
            F.col("c_mktsegment").alias("segmento"),
        )

    def enderecos(self) -> DataFrame:
        places = self.raw("nation").join(
            self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        key = F.col("c_custkey")
        blank = F.lit(None).cast("string")
        return (
            self.raw("customer")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                key.alias("id"),
                key.alias("cliente_id"),
                blank.alias("cep"),
                blank.alias("logradouro"),
                blank.alias("numero"),
                blank.alias("complemento"),
                blank.alias("bairro"),
                F.col("n_name").alias("cidade"),
                F.col("r_name").alias("estado"),
                F.lit(True).alias("endereco_principal"),
                _days_after("1995-01-01", key % 2400).alias("criado_em"),
            )
        )

    def fornecedores(self) -> DataFrame:
        blank = F.lit(None).cast("string")
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("id"),
            F.col("s_name").alias("nome"),
            blank.alias("email"),
            blank.alias("telefone"),
            blank.alias("cnpj"),
            F.lit(True).alias("ativo"),
            _days_after("1995-01-01", F.col("s_suppkey") % 2400).alias("criado_em"),
        )


def _unit_price(price: Column, quantity: Column) -> Column:
    """Price per piece, rounded half up from whole cents; decimal division is twice as slow.

    Only for the positive values that can enter the fact at all.
    """
    cents, pieces = F.round(price * 100).cast("bigint"), quantity.cast("bigint")
    whole = integer_quotient(cents * 2 + pieces, pieces * 2).cast("decimal(18,0)")
    return F.when(pieces > 0, (whole * F.lit("0.01").cast("decimal(2,2)")).cast(MONEY))


def _brand_number() -> Column:
    return F.substring_index("p_brand", "#", -1).cast("bigint")
