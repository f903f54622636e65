"""Reading, writing and incremental loading as queries.

The round trips write to fresh folders of the shared scratch area and return
what is read back.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.catalogue.base import (
    AS_OF,
    calendar,
    categories,
    customers,
    facts,
    products,
    query,
)
from granary.functions.scalars import nanos_to_timestamp as from_nanos
from granary.operators.upsert import upsert
from granary.plans import gold, incremental, lattice, silver, stored_analyses, totals
from granary.plans.arrivals import days_of, save_keys
from granary.plans.incremental import FACT_PARTITIONS
from granary.plans.jobs import Lake, Run, extract_job, silver_job
from granary.plans.stored_analyses import Dimensions
from granary.schemas import BRONZE, LONG, PARTITION_KEYS, TEXT, struct
from granary.session import scratch_path
from granary.sinks import versions
from granary.sinks.lake import stage, write_bronze
from granary.sinks.versions import NO_VALUE, VersionedTable
from granary.sources import discovery, lake
from granary.sources.relational import SOURCE_TABLES, changed_on
from granary.sources.testbed import Testbed

EXTRACT_DAY = dt.date(1996, 3, 15)
LOADED_UNTIL = dt.datetime(1999, 6, 30)
TODAY = dt.date(2000, 5, 31)
NOW = dt.datetime(2000, 5, 31, 4)


def _declared_facts(bed: Testbed) -> DataFrame:
    return facts(bed).drop("data_envio", "desconto", "imposto")


def _loaded(frame: DataFrame) -> DataFrame:
    """What an earlier run would have loaded."""
    return frame.filter(F.col("data_venda") <= F.lit(LOADED_UNTIL).cast(frame.schema["data_venda"].dataType))


@query
def extract_for_date(bed: Testbed) -> DataFrame:
    sales = next(t for t in SOURCE_TABLES if t.name == "vendas")
    return changed_on(bed.vendas(), sales, EXTRACT_DAY)


@query
def high_water_mark(bed: Testbed) -> DataFrame:
    return incremental.high_water_mark(facts(bed))


@query
def incremental_sales(bed: Testbed) -> DataFrame:
    """Facts of the sales that came, or may have changed, after the last load."""
    mark = incremental.high_water_mark(_loaded(bed.vendas())).first()["max_date"]
    headers = incremental.sales_since(bed.vendas(), mark, 3)
    batch = silver.facts_sales(headers, bed.itens_venda())
    return batch.drop("data_envio", "desconto", "imposto")


@query
def recent_period(bed: Testbed) -> DataFrame:
    return gold.monthly_sales(gold.recent_period(facts(bed), TODAY))


@query
def upsert_facts(bed: Testbed) -> DataFrame:
    """Earlier facts plus an overlapping batch give all facts, each once."""
    existing = silver.facts_sales(_loaded(bed.vendas()), bed.itens_venda())
    headers = incremental.sales_since(bed.vendas(), LOADED_UNTIL, 30)
    batch = silver.facts_sales(headers, bed.itens_venda())
    changed = headers.select(F.col("id").alias("venda_id"))
    merged = upsert(existing, batch, ["venda_id"], changed)
    return merged.drop("data_envio", "desconto", "imposto")


@query
def incremental_equals_full(bed: Testbed) -> DataFrame:
    """The fact after two incremental runs over extracts that differ: late sales, changed sales, lost and changed lines."""
    root = scratch_path(bed.spark, "incremental")
    target = Lake(root, f"silver_{root[-8:]}", f"gold_{root[-8:]}")
    sales, lines = bed.vendas(), bed.itens_venda()
    changed, late = F.col("id") % 5 == 0, F.col("id") % 7 == 0
    first = sales.filter(~late).withColumn("total", F.when(changed, F.col("total") + 1).otherwise(F.col("total")))
    sale = F.col("venda_id")
    more = lines.filter(sale % 13 == 0).withColumn("id", F.concat("id", F.lit("-gone")))
    before = lines.withColumn("quantidade", F.when(sale % 11 == 0, F.col("quantidade") + 1).otherwise(F.col("quantidade"))).unionByName(more)
    steps = ((first, before, EXTRACT_DAY), (sales.filter(late | changed), lines, EXTRACT_DAY + dt.timedelta(days=40)))
    for headers, own_lines, day in steps:
        write_bronze(headers, target.bronze, "vendas", day=day)
        write_bronze(own_lines, target.bronze, "itens_venda", day=day)
        silver_job(bed.spark, target, Run(dt.datetime.combine(day, dt.time(4)), incremental=True), only=("facts_vendas",))
    bed.spark.sql(f"DROP DATABASE {target.silver_database} CASCADE")
    return VersionedTable(bed.spark, target.silver, "facts_vendas").read().select(*_declared_facts(bed).columns)


@query
def deleted_sales(bed: Testbed) -> DataFrame:
    """The fact after every third sale of a year was deleted at the source; bronze keeps the headers, a key extract tells."""
    root = scratch_path(bed.spark, "deleted")
    target = Lake(root, f"silver_{root[-8:]}", f"gold_{root[-8:]}")
    sales, lines = bed.vendas(), bed.itens_venda()
    write_bronze(sales, target.bronze, "vendas", day=EXTRACT_DAY)
    write_bronze(lines, target.bronze, "itens_venda", day=EXTRACT_DAY)
    for left in (sales, sales.filter((F.year("data_venda") != TODAY.year) | (F.col("id") % 3 != 0))):
        save_keys(bed.spark, target.bronze, left, target.buckets, NOW)
        silver_job(bed.spark, target, Run(NOW, incremental=True), only=("facts_vendas",))
    bed.spark.sql(f"DROP DATABASE {target.silver_database} CASCADE")
    return VersionedTable(bed.spark, target.silver, "facts_vendas").read().select(*_declared_facts(bed).columns)


Stored = TypeVar("Stored")


def _after_two_loads(bed: Testbed, fact: DataFrame, refresh: Callable[[str, VersionedTable], Stored]) -> Stored:
    """What ``refresh`` stores after a first load and one that replaces, adds and removes sales in some months."""
    root = scratch_path(bed.spark, "totals")
    table, by_month = VersionedTable(bed.spark, root, "facts_vendas"), FACT_PARTITIONS[:2]
    # All sales by month, in as many files as tasks have rows of it; each load then reads whole months, and moves no row.
    loaded = VersionedTable(bed.spark, root, "facts_loaded")
    source = loaded.write(fact, by_month, in_place=True).commit(NOW)
    everything = loaded.read(source)
    sale, moment = F.col("venda_id"), everything.schema["data_venda"].dataType
    # Sales of two years as they were: some missing, some with another total, some since deleted.
    recent = F.col("ano") >= TODAY.year - 1

    def deleted(sales: DataFrame) -> DataFrame:
        return sales.filter(sale % 10 == 0).withColumns({"venda_id": -sale, "data_venda": F.lit(NOW).cast(moment), "ano": F.lit(2030)})

    def earlier(sales: DataFrame) -> DataFrame:
        before = sales.filter(~recent | (sale % 3 != 0)).withColumn("total_venda", F.when(recent, F.col("total_venda") + 1).otherwise(F.col("total_venda")))
        return before.unionByName(deleted(sales))

    table.write(totals.by_partition(earlier, loaded, source), by_month, in_place=True).commit(NOW)
    refresh(root, table)
    years = {p: p.split("/")[0].removeprefix("ano=") for p in source.folders}
    months = [p for p, year in years.items() if year != NO_VALUE and int(year) >= TODAY.year - 1]
    batch, gone = loaded.read(source, months).filter(recent), deleted(everything)
    changed = batch.select("venda_id").union(gone.select("venda_id"))
    days = days_of(batch.select(*FACT_PARTITIONS).union(gone.select(*FACT_PARTITIONS)))
    whole = totals.by_partition(lambda sales: sales.filter(recent), loaded, source, months)
    draft, _ = incremental.load_facts(table, table.current(), whole, changed, days, in_place=True)
    draft.commit(NOW)
    return refresh(root, table)


@query
def gold_from_stored_totals(bed: Testbed) -> DataFrame:
    """Rows and revenue per day, product and customer, from totals of which only touched partitions were built again."""
    stored = _after_two_loads(bed, _declared_facts(bed), lambda root, table: totals.refresh(bed.spark, root, table, NOW, incremental=True))
    parts = {"dia": (stored.per_day(), "dim_tempo_data"), "produto": (stored.per_product(), "produto_id"), "cliente": (stored.per_customer(), "cliente_id")}
    rows = [
        frame.select(F.lit(kind).alias("chave"), F.col(key).cast("string").alias("valor"), F.col("_rows").alias("linhas"), F.col("_items").alias("itens"), F.col("_value").alias("receita"))
        for kind, (frame, key) in parts.items()
    ]
    return rows[0].union(rows[1]).union(rows[2])


@query
def analyses_from_stored_totals(bed: Testbed) -> DataFrame:
    """Seven analyses from stored totals of which only touched partitions were built again; each row's key, count and amount."""
    goods, _ = stage(products(bed), "products")
    stored = _after_two_loads(bed, facts(bed), lambda root, table: lattice.refresh(bed.spark, root, table, goods, NOW, incremental=True))
    addresses = silver.dim_addresses(bed.enderecos())
    of = Dimensions(goods, customers(bed), addresses, calendar(bed))
    build, nothing = stored_analyses.tables(stored, of, AS_OF), F.lit(None)
    columns = {
        "vendas_por_periodo": (("periodo", "inicio"), F.col("vendas"), F.col("receita")),
        "valor_vida_clientes": (("cliente_id", "meses_ativos"), F.col("vendas"), F.col("valor_projetado")),
        "ticket_categorias": (("categoria_id", "categoria_nome"), F.col("vendas"), F.col("ticket_medio")),
        "margem_categorias": (("categoria_id",), nothing, F.col("margem")),
        "vendas_por_regiao": (("nivel", "estado", "cidade"), F.col("vendas"), F.col("receita")),
        "prazos_envio": (("ano",), F.col("envios"), F.col("participacao_frete")),
        "resultado_financeiro": (("ano", "mes"), nothing, F.col("receita_liquida")),
    }
    parts = [
        build[name]().select(
            F.lit(name).alias("analise"),
            F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("chave"),
            count.cast("long").alias("vendas"),
            amount.cast("double").alias("valor"),
        )
        for name, (keys, count, amount) in columns.items()
    ]
    return functools.reduce(DataFrame.union, parts)


@query
def read_bronze(bed: Testbed) -> DataFrame:
    """Two extracts, nanosecond moments, whole-number money; only the second has a column ``canal``."""
    root = scratch_path(bed.spark, "read-bronze")
    nanos = F.unix_micros(F.col("data_venda").cast("timestamp")) * 1000
    sales = bed.vendas().withColumns({"data_venda": nanos, "id": F.col("id").cast("int")})
    even = F.col("id") % 2 == 0
    write_bronze(sales.filter(even), root, "vendas", day=EXTRACT_DAY)
    write_bronze(sales.filter(~even).withColumn("canal", F.lit("web")), root, "vendas", day=TODAY)
    back = lake.read_bronze(bed.spark, f"{root}/vendas", BRONZE["vendas"])
    return back.withColumn("data_venda", F.col("data_venda").cast("timestamp_ntz")).drop(*lake.EXTRACT_KEYS)


@query
def bronze_roundtrip(bed: Testbed) -> DataFrame:
    """All sales to dated folders, one year of them a second time, and back."""
    root = scratch_path(bed.spark, "bronze")
    sales = bed.vendas()
    write_bronze(sales, root, "vendas", date_column="data_venda")
    again = sales.filter(F.year("data_venda") == 1997)
    write_bronze(again, root, "vendas", date_column="data_venda")
    back = lake.read_bronze(bed.spark, f"{root}/vendas", BRONZE["vendas"])
    return back.drop(*lake.EXTRACT_KEYS)


@query
def silver_roundtrip(bed: Testbed) -> DataFrame:
    """The fact written by day, and back."""
    table = _declared_facts(bed)
    keys = PARTITION_KEYS["facts_vendas"]
    target = VersionedTable(bed.spark, scratch_path(bed.spark, "silver"), "facts_vendas")
    versions.replace(target, table, NOW, keys)
    return target.read()


@query
def gold_roundtrip(bed: Testbed) -> DataFrame:
    """Monthly sales written by month, and back."""
    table = gold.monthly_sales(facts(bed))
    target = VersionedTable(bed.spark, scratch_path(bed.spark, "gold"), "vendas_mensais")
    versions.replace(target, table, NOW, PARTITION_KEYS["vendas_mensais"])
    return target.read()


@query
def gold_row_counts(bed: Testbed) -> DataFrame:
    """Rows of each gold table and of the fact, which is written once and then read."""
    fact, _ = stage(_declared_facts(bed), "facts")
    days, _ = stage(gold.day_totals(fact), "day-totals")
    per_product, _ = stage(gold.product_totals(fact), "product-totals")
    goods, kinds = products(bed), categories(bed)
    tables = {
        "facts_vendas": fact,
        "vendas_mensais": gold.monthly_from_days(days),
        "top_produtos": gold.top_from_products(per_product, goods, kinds),
        "clientes_vip": gold.vip_customers(fact, customers(bed)),
        "performance_categorias": gold.categories_from_products(per_product, goods, kinds),
        "vendas_diarias": gold.daily_from_days(days, calendar(bed)),
        "resumo_executivo": gold.summary_from_days(days, AS_OF.isoformat()),
    }
    counts = [
        t.agg(F.lit(name).alias("tabela"), F.count("*").alias("registros"))
        for name, t in tables.items()
    ]
    total = counts[0]
    for count in counts[1:]:
        total = total.unionByName(count)
    return total


@query
def adhoc_sql(bed: Testbed) -> DataFrame:
    """SQL over a silver fact and a silver dimension."""
    lake.register_views({"facts_vendas": facts(bed), "dim_produtos": products(bed)}, "silver_")
    return bed.spark.sql(
        """
        SELECT p.categoria_nome, f.ano, count(DISTINCT f.venda_id) AS vendas,
               sum(f.subtotal) AS receita
        FROM silver_facts_vendas f
        JOIN silver_dim_produtos p ON p.produto_id = f.dim_produto_id
        WHERE f.status_venda <> 'P'
        GROUP BY p.categoria_nome, f.ano
        """
    )


@query
def nanos_to_timestamp(bed: Testbed) -> DataFrame:
    """Event times as nanoseconds and back to timestamps."""
    nanos = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    return bed.raw("events").select("event_id", from_nanos(nanos).cast("timestamp_ntz").alias("ts"))


@query
def schema_report(bed: Testbed) -> DataFrame:
    """Every table in the folder, column by column, against a declaration of orders.

    The declaration lacks the priority, knows a comment that is not there, and
    takes the price for text.
    """
    declared = {
        "orders": struct(
            ("o_orderkey", LONG), ("o_custkey", LONG), ("o_orderstatus", TEXT), ("o_totalprice", TEXT),
            ("o_orderdate", T.TimestampNTZType()), ("o_comment", TEXT),
        )
    }
    return discovery.discover_schema(bed.spark, bed.folder, declared)


@query
def extract_report(bed: Testbed) -> DataFrame:
    """One day's extraction of all seven tables to bronze."""
    target = Lake(scratch_path(bed.spark, "lake"))
    run = Run(dt.datetime(1996, 3, 16, 4, 0))
    report = extract_job(bed.spark, lambda t: bed.bronze(t.name), target, EXTRACT_DAY, run)
    return report.select("tabela", "data_extracao", "registros", "situacao")
