import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from granary.operators.members import Ids
from granary.plans import incremental
from granary.plans.arrivals import STATE, Arrivals, bucket, key_table, line_marks, next_state
from granary.plans.jobs import Lake, Run, TablesFailed, extract_job, extract_keys_job, gold_job, run_layers, silver_job
from granary.sinks import versions
from granary.sinks.lake import write_bronze
from granary.sinks.versions import VersionedTable
from granary.sources.lake import read_layer_table
from granary.sources.relational import SOURCE_TABLES
from tests.rows import bronze, values

D1, D2, D3 = (dt.date(2025, 1, d) for d in (10, 11, 12))


@pytest.fixture
def lake(tmp_path):
    mark = uuid.uuid4().hex[:8]
    return Lake(str(tmp_path), f"silver_{mark}", f"gold_{mark}")


def at(day, hour=12):
    return dt.datetime.combine(day, dt.time(hour))


class Source:
    """A shop's tables on one day."""

    def __init__(self, spark, **tables):
        self.spark = spark
        self.tables = {
            "clientes": [{"criado_em": at(D1)}, {"criado_em": at(D1), "nome": "Rui"}],
            "produtos": [{"criado_em": at(D1)}, {"criado_em": at(D1), "preco": 20}],
            "categorias": [{"criado_em": at(D1)}],
            "fornecedores": [{"criado_em": at(D1)}],
            "enderecos": [{"criado_em": at(D1)}],
            **tables,
        }

    def __call__(self, table):
        return bronze(self.spark, table.name, *self.tables[table.name])


def sale(number, day, total=2000, **more):
    return {"id": number, "data_venda": at(day), "total": total, **more}


def line(number, sale_id, **more):
    return {"id": number, "venda_id": sale_id, **more}


def run(day, incremental_run=False):
    return Run(at(day, 23), "test", incremental_run)


SALES_ONLY = [t for t in SOURCE_TABLES if t.name in ("vendas", "itens_venda")]
FACT = ("item_venda_id", "venda_id", "total_venda", "ano", "mes", "dia")


def test_layers_end_to_end(spark, lake):
    source = Source(spark, vendas=[sale(1, D1), sale(2, D1)], itens_venda=[line(1, 1), line(2, 1, produto_id=2), line(3, 2)])
    report = extract_job(spark, source, lake, D1, run(D1))
    assert set(values(report, "tabela", "registros", "situacao")) >= {("vendas", 2, "success"), ("itens_venda", 3, "success")}
    results = {r.table: r for r in run_layers(spark, lake, run(D1))}
    assert {n: r.rows for n, r in results.items()} == {
        "dim_fornecedores": 1, "dim_categorias": 1, "dim_produtos": 2, "dim_clientes": 2, "dim_enderecos": 1,
        "dim_tempo": 1, "facts_vendas": 3, "vendas_mensais": 1, "top_produtos": 2, "clientes_vip": 1,
        "performance_categorias": 1, "vendas_diarias": 1, "resumo_executivo": 1,
    }
    for table in results:
        layer = "silver" if table.startswith(("dim_", "facts_")) else "gold"
        frame = read_layer_table(spark, getattr(lake, f"{layer}_database"), table)
        assert frame.count() == results[table].rows
        assert {f"{layer}_created_at", f"{layer}_execution_date", "triggered_by"} <= set(frame.columns)
    silver = spark.read.parquet(f"{lake.silver}/_execution_reports").first()
    assert (silver["total_records"], silver["total_value"], silver["total_items"]) == (3, 6000.0, 3)
    assert silver["last_processed_timestamp"] == "2025-01-10 12:00:00" and silver["is_incremental"] is False
    gold = spark.read.parquet(f"{lake.gold}/_gold_execution_reports").first()
    assert (gold["total_gold_records"], gold["source_facts_records"]) == (7, 3)
    assert spark.read.json(f"{lake.bronze}/_reports/*").first()["total_records"] == 12
    answer = spark.sql(f"SELECT receita_total FROM {lake.gold_database}.vendas_mensais").first()[0]
    assert answer == 6000


def test_one_failing_table_does_not_stop_the_others(spark, lake):
    source = Source(spark, vendas=[sale(1, D1)], itens_venda=[line(1, 1)])

    def load(table):
        if table.name == "clientes":
            raise ConnectionError("source is down")
        frame = source(table)
        return frame.drop("nome") if table.name == "fornecedores" else frame

    with pytest.raises(TablesFailed, match="clientes: source is down") as failed:
        extract_job(spark, load, lake, D1, run(D1))
    assert {r.table for r in failed.value.results} == {"vendas", "produtos", "itens_venda", "categorias", "fornecedores", "enderecos"}
    summary = spark.read.json(f"{lake.bronze}/_reports/*").first()
    assert summary["status"] == "failed" and summary["successful_extractions"] == 6
    with pytest.raises(TablesFailed) as failed:
        silver_job(spark, lake, run(D1))
    assert set(failed.value.errors) == {"dim_fornecedores", "dim_produtos", "dim_clientes"}
    assert "missing columns: nome" in failed.value.errors["dim_fornecedores"]
    assert read_layer_table(spark, lake.silver_database, "facts_vendas").count() == 1


def test_lines_extracted_every_day_enter_once(spark, lake):
    lines = [line(1, 1)]
    source = Source(spark, vendas=[sale(1, D1)], itens_venda=lines)
    for day in (D1, D2):
        extract_job(spark, source, lake, day, run(day), SALES_ONLY)
    silver_job(spark, lake, run(D2), only=("facts_vendas",))
    assert read_layer_table(spark, lake.silver_database, "facts_vendas").count() == 1


def test_empty_fact_keeps_old_tables_and_writes_one_summary(spark, lake):
    extract_job(spark, Source(spark, vendas=[sale(1, D1)], itens_venda=[line(1, 1, quantidade=0)]), lake, D1, run(D1))
    results = {r.table: r for r in run_layers(spark, lake, run(D1))}
    assert results["facts_vendas"].status == results["vendas_mensais"].status == "skipped"
    assert results["resumo_executivo"].rows == 1


DAYS = {
    D1: ([sale(1, D1), sale(2, D1, 50)], [line(1, 1), line(2, 2)]),
    D2: ([sale(3, D2)], [line(1, 1), line(2, 2), line(3, 3), line(4, 3, produto_id=2)]),
    D3: ([sale(4, D3), sale(5, D3)], [line(i, s) for i, s in ((1, 1), (2, 2), (3, 3), (5, 4), (6, 5))] + [line(4, 3, produto_id=2)]),
}


def load_days(spark, lake, silver_after):
    seen = []
    for day, (sales, lines) in DAYS.items():
        seen += sales
        extract_job(spark, Source(spark, vendas=seen, itens_venda=lines), lake, day, run(day), SALES_ONLY)
        if day in silver_after:
            silver_job(spark, lake, run(day, incremental_run=True), only=("facts_vendas", "dim_tempo"))
    return values(read_layer_table(spark, lake.silver_database, "facts_vendas"), *FACT), values(
        read_layer_table(spark, lake.silver_database, "dim_tempo"), "data", "tipo_dia"
    )


def test_full_run_equals_incremental_runs(spark, tmp_path):
    def fresh(name):
        mark = uuid.uuid4().hex[:8]
        return Lake(str(tmp_path / name), f"silver_{mark}", f"gold_{mark}")

    whole = load_days(spark, fresh("whole"), (D3,))
    assert load_days(spark, fresh("split"), (D1, D2, D3)) == whole
    assert [d for d, _ in whole[1]] == [D1, D2, D3]


def facts_after(spark, lake, *days):
    """Incremental silver runs over what the source holds on each day."""
    for day, sales, lines in days:
        extract_job(spark, Source(spark, vendas=sales, itens_venda=lines), lake, day, run(day), SALES_ONLY)
        silver_job(spark, lake, run(day, incremental_run=True), only=("facts_vendas",))
    return values(read_layer_table(spark, lake.silver_database, "facts_vendas"), *FACT)


def test_same_day_twice_changes_nothing(spark, lake):
    day = (D1, [sale(1, D1)], [line(1, 1)])
    assert facts_after(spark, lake, day) == facts_after(spark, lake, day)


def test_tie_with_the_mark_is_loaded(spark, lake):
    first = (D1, [sale(1, D1)], [line(1, 1)])
    second = (D1, [sale(1, D1), sale(2, D1)], [line(1, 1), line(2, 2)])
    assert [r[1] for r in facts_after(spark, lake, first, second)] == [1, 2]


def test_late_sale_of_an_earlier_day_is_loaded_once(spark, lake):
    """Its day is extracted again after a later day was loaded."""
    lines = [line(1, 1), line(2, 2), line(3, 3)]
    known = [sale(1, D1), sale(3, D3)]
    days = [(D1, known, lines), (D3, known, lines), (D2, known + [sale(2, D2)], lines)]
    loaded = facts_after(spark, lake, *days)
    assert [r[1] for r in loaded] == [1, 2, 3]


def test_whatever_arrives_late_equals_a_full_load(spark, tmp_path):
    """A sale thirty days late, a total that changes after thirty days, a line that goes and one that changes."""
    late = D3 + dt.timedelta(days=30)
    days = [
        (D1, [sale(1, D1), sale(2, D1)], [line(1, 1), line(2, 2), line(3, 2)]),
        (D3, [sale(1, D1), sale(2, D1), sale(3, D3)], [line(1, 1), line(2, 2), line(3, 2), line(4, 3)]),
        (late, [sale(1, D1, 99), sale(2, D1), sale(3, D3), sale(4, D2)], [line(1, 1), line(2, 2), line(4, 3, produto_id=2), line(5, 4)]),
    ]

    def fresh(name):
        mark = uuid.uuid4().hex[:8]
        return Lake(str(tmp_path / name), f"silver_{mark}", f"gold_{mark}")

    def written(lake, day, sales, lines):
        write_bronze(bronze(spark, "vendas", *sales), lake.bronze, "vendas", day=day)
        write_bronze(bronze(spark, "itens_venda", *lines), lake.bronze, "itens_venda", day=day)

    split, whole = fresh("split"), fresh("whole")
    for day in days:
        written(split, *day)
        silver_job(spark, split, run(day[0], incremental_run=True), only=("facts_vendas", "dim_tempo"))
    for day in days:
        written(whole, *day)
    silver_job(spark, whole, run(late), only=("facts_vendas", "dim_tempo"))
    for table, columns in (("facts_vendas", FACT), ("dim_tempo", ("data",))):
        tables = [values(read_layer_table(spark, lake.silver_database, table), *columns) for lake in (split, whole)]
        assert tables[0] == tables[1]


def test_lookback(spark):
    sales = bronze(spark, "vendas", sale(1, D1), sale(2, D3))
    mark = at(D3)
    assert values(incremental.sales_since(sales, mark, 3), "id") == [(1,), (2,)]
    assert values(incremental.sales_since(sales, mark, 0), "id") == [(2,)]
    assert incremental.sales_after(sales, mark).isEmpty()


def test_mark_of_nothing_is_the_beginning(spark):
    empty = bronze(spark, "vendas", sale(1, D1)).limit(0)
    assert incremental.high_water_mark(empty).first()["max_date"] == dt.datetime(1900, 1, 1)
    assert incremental.sales_since(bronze(spark, "vendas", sale(1, D1)), dt.datetime(1900, 1, 1), 3).count() == 1


def test_changed_sale_moves_day_and_drops_a_line(spark, lake):
    """The old day keeps no copy, even when it has no other sale."""
    from granary.plans import silver

    lines = bronze(spark, "itens_venda", line(1, 1), line(2, 1), line(3, 2))
    old = silver.facts_sales(bronze(spark, "vendas", sale(1, D1), sale(2, D2)), lines)
    table = VersionedTable(spark, lake.silver, "facts_vendas")
    versions.replace(table, old, at(D1), incremental.FACT_PARTITIONS)
    batch = silver.facts_sales(bronze(spark, "vendas", sale(1, D3)), bronze(spark, "itens_venda", line(1, 1)))
    changed = spark.createDataFrame([(1,)], "venda_id long")
    days = [{"ano": d.year, "mes": d.month, "dia": d.day} for d in (D1, D3)]
    for _ in range(2):
        draft, _ = incremental.load_facts(table, table.current(), batch, changed, days, {"top": F.max(incremental.of_batch(F.col("venda_id")))})
        assert (draft.rows, draft.metrics["new_rows"], draft.metrics["top"]) == (1, 1, 1)
        version = draft.commit(at(D3))
        assert values(table.read(), "item_venda_id", "dia") == [(1, 12), (3, 11)]
        assert set(version.folders) == {"ano=2025/mes=1/dia=11", "ano=2025/mes=1/dia=12"}


def test_old_lines_stay_with_their_tasks_until_a_day_has_many_files(spark, tmp_path):
    table, keys = VersionedTable(spark, str(tmp_path), "t"), ["ano", "mes", "dia"]
    rows = lambda *data: spark.createDataFrame([(sale, 2025, 1, 1, x) for sale, x in data], "venda_id long, ano int, mes int, dia int, x int")
    versions.replace(table, rows(*[(n, 0) for n in range(9)]), at(D1), keys)
    day, files = {"ano": 2025, "mes": 1, "dia": 1}, []
    for load in range(1, 7):
        batch = rows((load, load), (100 + load, load))
        draft, _ = incremental.load_facts(table, table.current(), batch, batch.select("venda_id"), [day])
        folder = draft.commit(at(D1)).folders["ano=2025/mes=1/dia=1"]
        files.append(len(list((tmp_path / "t" / folder).rglob("*.parquet"))))
        want = {n: 0 for n in range(9)} | {n: n for n in range(1, load + 1)} | {100 + n: n for n in range(1, load + 1)}
        assert sorted(values(table.read(), "venda_id", "x")) == sorted(want.items())
    assert files[0] == 2 and max(files) <= incremental.FILES_KEPT + 1 and 1 in files


def test_next_state_moves_to_its_buckets_at_once(spark, tmp_path):
    marks = line_marks(bronze(spark, "itens_venda", line(1, 1), line(2, 1), line(3, 2)))
    none = spark.createDataFrame([], STATE)
    loaded = spark.createDataFrame([(1, 2025, 1, 10), (1, 2025, 1, 10)], "venda_id long, ano int, mes int, dia int")
    arrived = spark.createDataFrame([(1,), (4,), (None,)], "venda_id long")
    state = next_state(marks, none, Ids(arrived, None), loaded, arrived, arrived.limit(0), 4)
    plan = state._jdf.queryExecution().toString().split("== Physical Plan ==")[1].splitlines()
    assert next(x for x in plan if "Exchange" in x).count("hashpartitioning(balde") == 1
    assert values(state, "venda_id", "linhas", "dia", "situacao") == [(1, 2, 10, 1), (2, 1, None, None), (4, None, None, 1)]
    arrivals = Arrivals(spark, str(tmp_path), 4, None)
    arrivals.save(state, at(D1))
    assert values(arrivals.table.read(), "venda_id", "balde") == values(state, "venda_id", "balde")


def test_incremental_gold_replaces_only_recent_months(spark, lake):
    old_day = dt.date(2020, 5, 1)
    sales = [sale(1, old_day), sale(2, D1)]
    first = Source(spark, vendas=sales[:1], itens_venda=[line(1, 1), line(2, 2)])
    extract_job(spark, first, lake, old_day, run(old_day), SALES_ONLY)
    extract_job(spark, Source(spark, vendas=sales, itens_venda=[line(1, 1), line(2, 2)]), lake, D1, run(D1))
    run_layers(spark, lake, run(D1))
    gold_job(spark, lake, Run(at(D2), "later", True))
    months = read_layer_table(spark, lake.gold_database, "vendas_mensais")
    assert values(months, "ano", "triggered_by") == [(2020, "test"), (2025, "later")]
    assert read_layer_table(spark, lake.gold_database, "resumo_executivo").first()["total_transacoes"] == 2
    gold_job(spark, lake, Run(at(D2), "later", True), rank_recent_only=True)
    assert read_layer_table(spark, lake.gold_database, "resumo_executivo").first()["total_transacoes"] == 1


def fresh(tmp_path, name):
    mark = uuid.uuid4().hex[:8]
    return Lake(str(tmp_path / name), f"silver_{mark}", f"gold_{mark}", buckets=4)


def extracted(spark, lake, day, sales, lines, keys=None):
    """Bronze of a day: the sales that changed, all lines, and the ids of all sales if ``keys`` gives these."""
    source = Source(spark, vendas=sales, itens_venda=lines)
    for table in SOURCE_TABLES:
        write_bronze(source(table), lake.bronze, table.name, day=day)
    if keys is not None:
        extract_keys_job(spark, Source(spark, vendas=keys), lake, run(day))


def test_deleted_sales_leave_the_fact(spark, tmp_path):
    """Only the buckets of the deleted ids are read; the headers that bronze still has do not bring them back."""
    lake = fresh(tmp_path, "lake")
    sales, lines = [sale(i, D1) for i in range(1, 41)], [line(i, i) for i in range(1, 41)]
    extracted(spark, lake, D1, sales, lines, sales)
    silver_job(spark, lake, run(D1, True), only=("facts_vendas",))
    # The lines are still there; the key extract alone tells.
    extract_keys_job(spark, Source(spark, vendas=sales[1:]), lake, run(D2))
    read = []
    original = VersionedTable.read

    def spy(self, version=None, parts=None):
        read.append((self.name, None if parts is None else sorted(parts)))
        return original(self, version, parts)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(VersionedTable, "read", spy)
        base = VersionedTable(spark, lake.silver, "facts_vendas").current()
        arrived = Arrivals(spark, lake.silver, lake.buckets, base)
        vanished, extract = arrived.vanished(key_table(spark, lake.bronze))
        assert values(vanished, "venda_id") == [(1,)] and extract == 2
    own = spark.range(1, 2).select(bucket(F.col("id"), 4)).first()[0]
    assert read == [("state", [f"balde={own}"]), ("vendas", [f"balde={own}"])]

    def facts():
        return sorted(r[1] for r in values(read_layer_table(spark, lake.silver_database, "facts_vendas"), *FACT))

    silver_job(spark, lake, run(D2, True), only=("facts_vendas",))
    assert facts() == list(range(2, 41))
    # A line of a deleted sale changes, and a full run: it stays away.
    lines[0] = line(1, 1, quantidade=7)
    write_bronze(bronze(spark, "itens_venda", *lines), lake.bronze, "itens_venda", day=D3)
    silver_job(spark, lake, run(D3, True), only=("facts_vendas",))
    assert facts() == list(range(2, 41))
    silver_job(spark, lake, run(D3), only=("facts_vendas",))
    assert facts() == list(range(2, 41))
    # Until it arrives again.
    write_bronze(bronze(spark, "vendas", sale(1, D3)), lake.bronze, "vendas", day=D3)
    silver_job(spark, lake, run(D3, True), only=("facts_vendas",))
    assert facts() == list(range(1, 41))


def test_two_runs_on_the_same_arrivals_load_each_sale_once(spark, tmp_path, monkeypatch):
    """The second run starts and ends while the first has its files written but not committed."""
    lake = fresh(tmp_path, "lake")
    extracted(spark, lake, D1, [sale(1, D1)], [line(1, 1)])
    silver_job(spark, lake, run(D1, True), only=("facts_vendas",))
    extracted(spark, lake, D2, [sale(2, D1)], [line(1, 1), line(2, 2)])
    original, entered = versions.Draft.commit, []

    def commit(self, *arguments):
        if self.table.name == "facts_vendas" and not entered:
            entered.append(True)
            silver_job(spark, lake, run(D2, True), only=("facts_vendas",))
        return original(self, *arguments)

    monkeypatch.setattr(versions.Draft, "commit", commit)
    with pytest.raises(TablesFailed, match="committed by another run"):
        silver_job(spark, lake, run(D2, True), only=("facts_vendas",))
    monkeypatch.undo()
    loaded = values(read_layer_table(spark, lake.silver_database, "facts_vendas"), *FACT)
    assert [r[1] for r in loaded] == [1, 2]
    silver_job(spark, lake, run(D2, True), only=("facts_vendas",))
    assert values(read_layer_table(spark, lake.silver_database, "facts_vendas"), *FACT) == loaded


def test_a_run_that_fails_before_its_commit_is_repeated(spark, tmp_path, monkeypatch):
    lake = fresh(tmp_path, "lake")
    extracted(spark, lake, D1, [sale(1, D1), sale(2, D2)], [line(1, 1), line(2, 2)])
    silver_job(spark, lake, run(D1, True), only=("facts_vendas",))
    extracted(spark, lake, D2, [sale(2, D3)], [line(1, 1), line(2, 2)])
    original = versions.Draft.commit

    def commit(self, *arguments):
        if self.table.name == "facts_vendas":
            raise OSError("lost")
        return original(self, *arguments)

    monkeypatch.setattr(versions.Draft, "commit", commit)
    with pytest.raises(TablesFailed, match="lost"):
        silver_job(spark, lake, run(D2, True), only=("facts_vendas",))
    monkeypatch.undo()
    silver_job(spark, lake, run(D2, True), only=("facts_vendas",))
    loaded = values(read_layer_table(spark, lake.silver_database, "facts_vendas"), "venda_id", "dia")
    assert loaded == [(1, D1.day), (2, D3.day)]


GOLD_COLUMNS = {
    "vendas_mensais": ("ano", "mes", "total_vendas", "receita_total", "itens_vendidos", "ticket_medio", "clientes_unicos"),
    "top_produtos": ("produto_id", "quantidade_vendida", "receita_produto", "numero_vendas", "preco_medio"),
    "clientes_vip": ("cliente_id", "valor_total_compras", "numero_compras", "ultima_compra", "primeira_compra"),
    "performance_categorias": ("categoria_id", "receita_categoria", "itens_vendidos", "numero_transacoes", "preco_medio_categoria"),
    "vendas_diarias": ("data", "vendas_dia", "receita_dia", "itens_dia"),
    "resumo_executivo": ("total_transacoes", "receita_total_periodo", "total_clientes", "data_ultima_venda", "data_primeira_venda"),
}


def gold_tables(spark, lake):
    return {name: values(read_layer_table(spark, lake.gold_database, name), *columns) for name, columns in GOLD_COLUMNS.items()}


def test_incremental_gold_reads_touched_days_only_and_equals_a_full_run(spark, tmp_path, monkeypatch):
    """A late sale, a sale that moves to another day, a changed line and a deleted sale that empties its day."""
    day4 = dt.date(2025, 1, 20)
    lines = [line(i, i, produto_id=1 + i % 2) for i in range(1, 8)]
    sales = [sale(1, D1), sale(2, D1, 50), sale(3, D2), sale(4, D2, 3000, cliente_id=2), sale(5, D3), sale(6, D3), sale(7, day4)]
    changed = [line(1, 1, produto_id=2, quantidade=9), *lines[1:]]
    after = [sale(1, D1), sale(2, D1, 50), sale(3, day4), sale(4, D2, 3000, cliente_id=2), sale(6, D3), sale(8, D2)]

    lake = fresh(tmp_path, "split")
    extracted(spark, lake, D1, sales, lines)
    run_layers(spark, lake, run(D1, True))
    extracted(spark, lake, D2, [after[2], after[5]], [*changed, line(8, 8)], after)
    silver_job(spark, lake, run(D2, True))
    read = []
    original = VersionedTable.read

    def spy(self, version=None, parts=None):
        frame = original(self, version, parts)
        if self.name == "facts_vendas":
            read.append(sorted({f.rsplit("/", 1)[0].split("/", 1)[0] + f[f.index("/ano=") : f.rindex("/")] for f in (x.split(self.root, 1)[1][1:] for x in frame.inputFiles())}))
        return frame

    monkeypatch.setattr(VersionedTable, "read", spy)
    gold_job(spark, lake, run(D2, True))
    monkeypatch.undo()
    days = {f.split("/", 1)[1] for found in read for f in found}
    # Day 12 lost one of its sales (5), day 20 lost sale 7 and gained sale 3, day 11 lost 3 and gained 8, day 10 has the changed line.
    assert days == {f"ano=2025/mes=1/dia={d}" for d in (10, 11, 12, 20)} and len(read) == 2

    whole = fresh(tmp_path, "whole")
    extracted(spark, whole, D1, after, [*changed, line(8, 8)])
    run_layers(spark, whole, run(D1))
    assert gold_tables(spark, lake) == gold_tables(spark, whole)

    # Nothing new: no day of the fact is read.
    read.clear()
    monkeypatch.setattr(VersionedTable, "read", spy)
    gold_job(spark, lake, run(D2, True))
    assert read == [] and gold_tables(spark, lake) == gold_tables(spark, whole)


def test_untouched_days_are_not_read_again(spark, tmp_path, monkeypatch):
    lake = fresh(tmp_path, "lake")
    extracted(spark, lake, D1, [sale(1, D1), sale(2, D2)], [line(1, 1), line(2, 2)])
    run_layers(spark, lake, run(D1, True))
    extracted(spark, lake, D3, [sale(3, D3)], [line(i, i) for i in (1, 2, 3)])
    silver_job(spark, lake, run(D3, True))
    read = []
    original = VersionedTable.read
    monkeypatch.setattr(VersionedTable, "read", lambda self, version=None, parts=None: (read.append(parts) if self.name == "facts_vendas" else None) or original(self, version, parts))
    gold_job(spark, lake, run(D3, True))
    assert read == [{"ano=2025/mes=1/dia=12"}] * 2
    assert [r[1] for r in gold_tables(spark, lake)["vendas_diarias"]] == [1, 1, 1]


def test_marks_notice_values_that_move_and_lines_that_repeat(spark):
    def marks(*rows):
        frame = spark.createDataFrame([(1, *r) for r in rows], "venda_id long, a long, b long")
        return line_marks(frame).first()[1:]

    assert marks((None, 5)) != marks((5, None))
    assert marks((1, 2), (1, 2), (3, 4)) != marks((5, 6), (5, 6), (3, 4))
    assert marks((1, 2), (3, 4)) == marks((3, 4), (1, 2))
    wider = spark.createDataFrame([(1, 1, 2, None)], "venda_id long, a long, b long, c string")
    assert line_marks(wider).first()[1:] == marks((1, 2))


def test_rows_that_break_rules_are_listed_and_counts_add_up(spark, tmp_path):
    lake = fresh(tmp_path, "lake")
    people = [{"id": 1, "email": " a@b.co ", "telefone": "+55 (11) 98888-7777", "cpf": "529.982.247-25", "criado_em": at(D1)}, {"id": 2, "email": "nobody", "criado_em": at(D1)}, {"id": None, "criado_em": at(D1)}]
    lines = [line(1, 1), line(2, 1, quantidade=0), line(3, 2, produto_id=None), line(4, 2), line(5, 3, quantidade=0, produto_id=None)]
    sales = [sale(1, D1), sale(2, D2, cliente_id=None), sale(3, D2)]
    source = Source(spark, clientes=people, vendas=sales, itens_venda=lines)
    for table in SOURCE_TABLES:
        write_bronze(source(table), lake.bronze, table.name, day=D1)
    results = {r.table: r.rows for r in silver_job(spark, lake, run(D1, True))}
    assert results["dim_clientes"] == 2 and results["facts_vendas"] == 1
    shown = spark.table(f"{lake.silver_database}.dim_clientes").filter("cliente_id = 1")
    assert values(shown, "cliente_email", "cliente_telefone", "cliente_cpf") == [("a@b.co", "11988887777", "52998224725")]
    listed = spark.table(f"{lake.silver_database}.linhas_com_motivos")
    assert values(listed, "tabela", "chave", "motivos", "recusada") == [("clientes", "2", ["email_invalido"], False), ("clientes", None, ["id_ausente"], True)]
    refused = spark.table(f"{lake.silver_database}.vendas_recusadas")
    assert values(refused, "item_venda_id", "motivos", "dia") == [
        (2, ["quantidade_invalido"], 10), (3, ["dim_cliente_id_ausente", "dim_produto_id_ausente"], 11),
        (4, ["dim_cliente_id_ausente"], 11), (5, ["quantidade_invalido", "dim_produto_id_ausente"], 11),
    ]
    assert refused.count() + results["facts_vendas"] == len(lines)
    # The customer's address is mended, and so are a line and a header.
    people[1]["email"] = "b@b.co"
    lines[1] = line(2, 1)
    source = Source(spark, clientes=people, vendas=[sale(2, D2)], itens_venda=lines)
    for table in SOURCE_TABLES:
        write_bronze(source(table), lake.bronze, table.name, day=D2)
    silver_job(spark, lake, run(D2, True))
    assert values(spark.table(f"{lake.silver_database}.linhas_com_motivos"), "motivos") == [(["id_ausente"],)]
    assert values(spark.table(f"{lake.silver_database}.facts_vendas"), "item_venda_id") == [(1,), (2,), (4,)]
    assert values(spark.table(f"{lake.silver_database}.vendas_recusadas"), "item_venda_id") == [(3,), (5,)]


def test_a_column_of_day_two_appears_in_all_layers(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), f"silver_{uuid.uuid4().hex[:8]}", f"gold_{uuid.uuid4().hex[:8]}", f"bronze_{uuid.uuid4().hex[:8]}", 4)
    sales, lines = [sale(1, D1), sale(2, D2)], [line(1, 1), line(2, 2)]
    extract_job(spark, Source(spark, vendas=sales, itens_venda=lines), lake, D1, run(D1), SALES_ONLY)
    silver_job(spark, lake, run(D1, True), only=("facts_vendas",))

    def load(table):
        frame = Source(spark, vendas=sales, itens_venda=lines)(table)
        return frame.withColumn("canal", F.when(F.col("id") == 2, "web")) if table.name == "itens_venda" else frame

    extract_job(spark, load, lake, D2, run(D2), SALES_ONLY)
    silver_job(spark, lake, run(D2, True), only=("facts_vendas",))
    assert values(spark.sql(f"SELECT * FROM {lake.bronze_database}.itens_venda"), "id", "canal", "day") == [(1, None, 10), (1, None, 11), (2, "web", 11), (2, None, 10)]
    assert values(spark.sql(f"SELECT * FROM {lake.silver_database}.facts_vendas"), "venda_id", "canal") == [(1, None), (2, "web")]
