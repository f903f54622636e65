import datetime as dt
import json
import time
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from granary.schemas import BRONZE, GOLD, SILVER, struct
from granary.sinks import lake as sinks
from granary.sinks import reports
from granary.sources import discovery, lake, relational
from granary.streaming import new_files
from tests.rows import bronze, values

DAY = dt.date(2025, 3, 9)


def data_files(path):
    return sorted(p for p in path.rglob("*.parquet"))


def test_bronze_write_is_dated_and_a_rerun_replaces_the_date(spark, tmp_path):
    root = str(tmp_path)
    first = sinks.write_bronze(bronze(spark, "vendas", {}, {}), root, "vendas", day=DAY)
    other = sinks.write_bronze(bronze(spark, "vendas", {"id": 9}), root, "vendas", day=dt.date(2025, 3, 10))
    again = sinks.write_bronze(bronze(spark, "vendas", {"id": 5}), root, "vendas", day=DAY)
    assert (first.rows, other.rows, again.rows, again.status) == (2, 1, 1, "success")
    assert (tmp_path / "vendas/year=2025/month=03/day=09").is_dir()
    back = lake.read_bronze(spark, f"{root}/vendas", BRONZE["vendas"])
    assert values(back, "id", "year", "month", "day") == [(5, 2025, 3, 9), (9, 2025, 3, 10)]
    latest = lake.read_bronze(spark, f"{root}/vendas", BRONZE["vendas"], only_latest=True)
    assert values(latest, "id") == [(9,)]
    assert all("/day=10/" in f for f in latest.inputFiles())


def test_empty_extract_writes_nothing(spark, tmp_path):
    sinks.write_bronze(bronze(spark, "vendas", {}), str(tmp_path), "vendas", day=DAY)
    before = data_files(tmp_path)
    result = sinks.write_bronze(bronze(spark, "vendas", {}).limit(0), str(tmp_path), "vendas", day=DAY)
    assert (result.rows, result.status) == (0, "empty") and data_files(tmp_path) == before


def test_bronze_from_pandas_with_nanoseconds(spark, tmp_path):
    folder = tmp_path / "categorias/year=2025/month=03/day=09"
    folder.mkdir(parents=True)
    frame = pd.DataFrame(
        {
            "id": [1, 2], "nome": ["a", "b"], "descricao": ["x", None], "ativa": [1, 0],
            "criado_em": pd.to_datetime(["2025-01-01 00:00:00.123456789", None]).astype("datetime64[ns]"),
        }
    )
    frame.to_parquet(folder / "categorias_2025-03-09.parquet", index=False)
    back = lake.read_bronze(spark, str(tmp_path / "categorias"), BRONZE["categorias"])
    assert dict(back.dtypes)["criado_em"] == "timestamp" and dict(back.dtypes)["ativa"] == "boolean"
    assert values(back, "id", "ativa", F.col("criado_em").cast("string")) == [
        (1, True, "2025-01-01 00:00:00.123456"), (2, False, None),
    ]


def test_missing_column_is_named_and_extra_is_kept(spark):
    frame = bronze(spark, "categorias", {}).withColumn("cor", F.lit("azul"))
    assert "cor" in lake.conform(frame, BRONZE["categorias"]).columns
    with pytest.raises(lake.MissingColumns, match="nome"):
        lake.conform(frame.drop("nome"), BRONZE["categorias"])


def test_missing_table_is_empty_with_declared_columns(spark):
    for name, schema in {**SILVER, **GOLD}.items():
        frame = lake.read_layer_table(spark, "nowhere", name)
        assert frame.schema == schema and frame.isEmpty()


def test_replace_table_skips_empty_and_may_read_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(1, 2025), (2, 2024)], "id int, ano int")
    assert sinks.replace_table(frame, path, "t", ["ano"]).rows == 2
    assert sinks.replace_table(frame.limit(0), path, "t", ["ano"]).status == "skipped"
    assert spark.read.parquet(path).count() == 2
    own = spark.read.parquet(path).filter("id = 1")
    assert sinks.replace_table(own, path, "t", ["ano"], {"top": F.max("id")}).metrics == {"top": 1}
    spark.catalog.refreshByPath(path)
    assert values(spark.read.parquet(path), "id", "ano") == [(1, 2025)]


def test_overwrite_partitions_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_partitions(spark.createDataFrame([(1, 1), (2, 2)], "v int, mes int"), path, "t", ["mes"])
    sinks.overwrite_partitions(spark.createDataFrame([(3, 2)], "v int, mes int"), path, "t", ["mes"])
    assert values(spark.read.parquet(path), "v", "mes") == [(1, 1), (3, 2)]


def test_compaction(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(100).withColumn("mes", F.col("id") % 2).repartition(10).write.partitionBy("mes").parquet(str(path))
    assert len(data_files(path)) == 20
    assert sinks.compact(spark, str(path), ["mes"]).rows == 100
    assert len(data_files(path)) == 2
    spark.catalog.refreshByPath(str(path))
    assert spark.read.parquet(str(path)).count() == 100


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    from granary.session import settings

    frame = spark.range(300_000).select(
        F.repeat(F.sha2(F.col("id").cast("string"), 256), 2).alias("x"),
        F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id") % 7 + 2).alias("mes"),
    )
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m"}):
        assert sinks.overwrite_partitions(frame, str(tmp_path / "t"), "t", ["mes"]).rows == 300_000
    assert len(data_files(tmp_path / "t/mes=1")) > 1
    cold = [len(data_files(tmp_path / f"t/mes={m}")) for m in range(2, 9)]
    assert min(cold) == 1


def test_manifest_and_reports(spark, tmp_path):
    result = sinks.write_bronze(bronze(spark, "vendas", {}, {}), str(tmp_path), "vendas", day=DAY)
    row = reports.manifest(spark, [result], "2025-03-09", {"vendas": "incremental"}).first()
    assert (row["registros"], row["tipo"], row["formato"], row["compressao"], row["arquivos"]) == (
        2, "incremental", "parquet", "snappy", len(data_files(tmp_path)),
    )
    now = dt.datetime(2025, 3, 9, 6)
    silver = reports.silver_report(spark, "2025-03-09", "me", False, {"total_records": None}, None, now)
    assert tuple(silver.first()) == ("2025-03-09", "me", False, 0, 0.0, 0, None, "2025-03-09 06:00:00")
    gold = reports.gold_report(spark, "2025-03-09", "me", True, 5, 7, now)
    for day in ("2025-03-09", "2025-03-08"):
        reports.save_report(gold.withColumn("execution_date", F.lit(day)), str(tmp_path), "_gold_execution_reports")
    saved = spark.read.parquet(f"{tmp_path}/_gold_execution_reports")
    assert saved.count() == 2 and saved.first()["total_gold_records"] == 5


def test_extract_summary(spark):
    report = reports.extract_report(
        spark,
        [
            ("a", "2025-03-09", 5, "success", "p", None, 0.1),
            ("b", "2025-03-09", 0, "empty", None, None, 0.0),
            ("c", "2025-03-09", 0, "error", None, "no such table", 0.0),
        ],
    )
    text = json.loads(reports.as_json_text(reports.extract_summary(report, "extract", dt.datetime(2025, 3, 9, 4))))
    assert (text["total_tables"], text["successful_extractions"], text["total_records"]) == (3, 1, 5)
    assert text["status"] == "failed" and text["execution_date"] == "2025-03-09"
    assert text["tables"]["a"] == {"records": 5, "status": "success", "dates_processed": ["2025-03-09"], "format": "parquet"}
    assert text["tables"]["b"]["status"] == "no_data" and text["tables"]["b"]["dates_processed"] == ["2025-03-09"]
    assert text["tables"]["c"]["dates_processed"] == []


def test_schema_discovery(spark, tmp_path):
    root = str(tmp_path / "silver")
    spark.createDataFrame([(1, "x")], "id long, nome string").write.parquet(f"{root}/t/year=2025")
    spark.createDataFrame([(1, 2)], "id long, novo int").write.parquet(f"{root}/t/year=2026")
    spark.range(1).write.parquet(f"{root}/_reports/r")
    declared = {"t": struct(("id", BRONZE["vendas"]["id"].dataType), ("nome", SILVER["dim_tempo"]["data"].dataType), ("velho", BRONZE["vendas"]["id"].dataType))}
    assert discovery.find_tables(spark, root) == ["t"]
    got = discovery.discover_schema(spark, root, declared)
    assert {(r["coluna"], r["situacao"]) for r in got.collect()} == {
        ("id", "declared"), ("nome", "retyped"), ("velho", "removed"), ("novo", "added"), ("year", "added"),
    }


def test_schema_conflict_is_a_row(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{root}/t/p=1")
    spark.createDataFrame([("x",)], "a string").write.parquet(f"{root}/t/p=2")
    got = discovery.discover_schema(spark, root, {}).collect()
    assert [(r["tabela"], r["coluna"], r["situacao"]) for r in got] == [("t", "*", "conflict")]


def test_registry():
    tables = {t.name: t for t in relational.SOURCE_TABLES}
    assert set(tables) == set(BRONZE) and len(tables) == 7
    assert [n for n, t in tables.items() if not t.incremental] == ["itens_venda"]


def test_paging_options():
    table = relational.SOURCE_TABLES[0]
    assert relational.key_range_query(table) == "SELECT MIN(id) AS low, MAX(id) AS high FROM vendas"
    assert relational.page_options(table, 1, 1000, 4) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "1000", "numPartitions": "4",
    }
    assert relational.page_options(table, None, None, 4) == {}
    assert relational.page_options(table, 1, 1000, 1) == {}
    assert relational.page_options(table, 1, 2, 8)["numPartitions"] == "2"


def test_changes_of_one_day_include_updates_and_are_pushed_down(spark, tmp_path):
    moments = [dt.datetime(2025, 3, 8, 23, 59, 59), dt.datetime(2025, 3, 9), dt.datetime(2025, 3, 9, 23, 59, 59), dt.datetime(2025, 3, 10)]
    rows = [(i, m, dt.datetime(2025, 3, 9, 8) if i == 0 else None) for i, m in enumerate(moments)]
    spark.createDataFrame(rows, "id long, criado_em timestamp, atualizado_em timestamp").write.parquet(f"{tmp_path}/t")
    frame = spark.read.parquet(f"{tmp_path}/t")
    new = relational.changed_on(frame, relational.SourceTable("t", "criado_em", True), DAY)
    assert values(new, "id") == [(1,), (2,)]
    assert "GreaterThanOrEqual(criado_em" in new._jdf.queryExecution().executedPlan().toString()
    changed = relational.changed_on(frame, relational.SourceTable("t", "criado_em", True, "atualizado_em"), DAY)
    assert values(changed, "id") == [(0,), (1,), (2,)]
    assert relational.changed_on(frame, relational.SourceTable("t", None, False), DAY) is frame


def test_each_file_is_processed_once(spark, tmp_path):
    root, target, mark = str(tmp_path / "bronze"), str(tmp_path / "out"), str(tmp_path / "mark")

    def run():
        stream = new_files.new_rows(spark, f"{root}/categorias", BRONZE["categorias"])
        return new_files.process_new_files(stream, new_files.append_batches(target), mark)

    sinks.write_bronze(bronze(spark, "categorias", {}, {}, {}), root, "categorias", day=DAY)
    assert run() == 1 and spark.read.parquet(target).count() == 3
    assert run() == 0 and spark.read.parquet(target).count() == 3
    sinks.write_bronze(bronze(spark, "categorias", {"id": 9}), root, "categorias", day=dt.date(2025, 3, 10))
    assert run() == 1 and spark.read.parquet(target).count() == 4


def test_stream_of_nanosecond_files(spark, tmp_path):
    folder = tmp_path / "t"
    folder.mkdir()
    pd.DataFrame({"id": [1], "criado_em": pd.to_datetime(["2025-01-01"]).astype("datetime64[ns]")}).to_parquet(
        folder / "a.parquet", index=False
    )
    schema = struct(("id", BRONZE["vendas"]["id"].dataType), ("criado_em", BRONZE["clientes"]["criado_em"].dataType))
    stream = new_files.new_rows(spark, str(folder), schema, nanoseconds=True)
    target = str(tmp_path / "out")
    new_files.process_new_files(stream, new_files.append_batches(target), str(tmp_path / "mark"))
    assert values(spark.read.parquet(target), F.col("criado_em").cast("string")) == [("2025-01-01 00:00:00",)]


def test_views_for_sql(spark):
    name = f"v_{uuid.uuid4().hex}"
    lake.register_views({name: spark.range(3)}, "silver_")
    assert spark.sql(f"SELECT sum(id) FROM silver_{name}").first()[0] == 3


def test_scratch_folder_follows_the_session(spark):
    from granary.session import scratch_path, shuffle_partitions_for

    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shuffle_partitions_for(0, 8) == 8
    assert shuffle_partitions_for(100 * 1024**4, 8) == 819_200


def test_manifest_counts_the_files_of_its_own_extract(spark, tmp_path):
    sinks.write_bronze(bronze(spark, "vendas", {}, {}), str(tmp_path), "vendas", day=DAY)
    second = sinks.write_bronze(bronze(spark, "vendas", {"id": 9}).coalesce(1), str(tmp_path), "vendas", day=dt.date(2025, 3, 10))
    row = reports.manifest(spark, [second], "2025-03-10", {}).first()
    assert row["arquivos"] == 1 and row["caminho"].endswith("month=03/day=10")


def test_columns_of_newer_extracts_are_kept(spark, tmp_path):
    sinks.write_bronze(bronze(spark, "vendas", {}), str(tmp_path), "vendas", day=DAY)
    newer = bronze(spark, "vendas", {"id": 9}).withColumn("atualizado_em", F.lit("x"))
    sinks.write_bronze(newer, str(tmp_path), "vendas", day=dt.date(2025, 3, 10))
    back = lake.read_bronze(spark, f"{tmp_path}/vendas", BRONZE["vendas"])
    assert values(back, "id", "atualizado_em") == [(1, None), (9, "x")]


def test_reading_opens_only_the_footers_it_needs(spark, tmp_path):
    """An unreadable old file matters to nobody who plans a read or takes the newest extract."""
    root, days = str(tmp_path), [dt.date(2025, 3, d) for d in (8, 9, 10)]
    for number, day in enumerate(days):
        frame = bronze(spark, "vendas", {"id": number}).withColumn(f"novo{number}", F.lit(number))
        sinks.write_bronze(frame.coalesce(1), root, "vendas", day=day)
    for file in data_files(tmp_path / "vendas/year=2025/month=03/day=08"):
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
        file.write_bytes(b"no parquet at all")
    whole = lake.read_bronze(spark, f"{root}/vendas", BRONZE["vendas"])
    assert {"novo0", "novo1", "novo2"} <= set(whole.columns)
    assert values(whole.filter("day > 8"), "id", "novo1", "novo2") == [(1, 1, None), (2, None, 2)]
    latest = lake.read_bronze(spark, f"{root}/vendas", BRONZE["vendas"], only_latest=True)
    assert values(latest, "id", "novo2") == [(2, 2)] and "novo1" not in latest.columns


def test_folders_without_notes_and_changed_types_are_read_from_footers(spark, tmp_path):
    path = f"{tmp_path}/vendas"
    sinks.write_bronze(bronze(spark, "vendas", {}), str(tmp_path), "vendas", day=DAY)
    assert lake.noted_schema(spark, path) is not None
    bronze(spark, "vendas", {"id": 7}).write.parquet(f"{path}/year=2025/month=03/day=11")
    assert lake.noted_schema(spark, path) is None
    assert values(lake.read_bronze(spark, path, BRONZE["vendas"]), "id") == [(1,), (7,)]
    lake.note_schema(spark, f"{path}/year=2025/month=03/day=11", struct(("id", BRONZE["itens_venda"]["quantidade"].dataType)))
    assert lake.noted_schema(spark, path) is None


def test_catalog_learns_columns_and_moves(spark, tmp_path):
    database, keys = f"bronze_{uuid.uuid4().hex[:8]}", lake.EXTRACT_KEYS

    def extracted(root, day, frame):
        result = sinks.write_bronze(frame, root, "vendas", day=day)
        lake.register_table(spark, database, "vendas", result.path, frame.schema, keys, result.folder)

    first = bronze(spark, "vendas", {})
    extracted(f"{tmp_path}/a", DAY, first)
    extracted(f"{tmp_path}/a", dt.date(2025, 3, 10), bronze(spark, "vendas", {"id": 2}).withColumn("canal", F.lit("web")))
    shown = spark.sql(f"SELECT * FROM {database}.vendas")
    assert values(shown, "id", "canal", "year", "month", "day") == [(1, None, 2025, 3, 9), (2, "web", 2025, 3, 10)]
    assert shown.columns[-4:] == ["canal", "year", "month", "day"]
    extracted(f"{tmp_path}/b", DAY, bronze(spark, "vendas", {"id": 8}))
    assert values(spark.table(f"{database}.vendas"), "id") == [(8,)]
    assert lake.read_bronze(spark, f"{tmp_path}/a/vendas", BRONZE["vendas"]).count() == 2


def test_a_write_leaves_no_shuffle_files(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffled()
    staged, _ = sinks.stage(spark.range(10_000).groupBy((F.col("id") % 97).alias("k")).count(), "counts")
    until = time.monotonic() + 20  # they go a moment later
    while shuffled() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not shuffled() - before and staged.count() == 97
