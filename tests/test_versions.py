import datetime as dt
import uuid

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from granary.sinks import versions
from granary.sinks.versions import Conflict, VersionedTable, changed_parts
from tests.rows import values

AT = dt.datetime(2025, 3, 9, 4)
KEYS = ["ano", "mes"]


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path), "t")


@pytest.fixture
def database():
    return f"db_{uuid.uuid4().hex[:8]}"


def rows(spark, *data):
    return spark.createDataFrame(list(data), "id int, ano int, mes int")


def test_whole_table_and_partitions(spark, table):
    assert versions.replace(table, rows(spark, (1, 2024, 1), (2, 2024, 2), (3, None, 2)), AT, KEYS).rows == 3
    first = table.current()
    versions.replace(table, rows(spark, (9, 2024, 2)), AT, KEYS, replaced=["ano=2024/mes=2", "ano=__HIVE_DEFAULT_PARTITION__/mes=2"])
    assert values(table.read(), "id", "ano", "mes") == [(1, 2024, 1), (9, 2024, 2)]
    assert values(table.read(first), "id") == [(1,), (2,), (3,)]
    assert values(table.read(parts=["ano=2024/mes=1"]), "id") == [(1,)]
    assert changed_parts(first, table.current()) == ({"ano=2024/mes=2"}, {"ano=__HIVE_DEFAULT_PARTITION__/mes=2"})
    assert changed_parts(None, first)[0] == set(first.folders)


def test_a_partition_that_lost_its_rows_is_gone(spark, table):
    versions.replace(table, rows(spark, (1, 2024, 1), (2, 2024, 2)), AT, KEYS)
    assert versions.replace(table, rows(spark, (1, 1, 1)).limit(0), AT, KEYS, replaced=["ano=2024/mes=2"]).status == "skipped"
    assert values(table.read(), "id") == [(1,)]
    versions.replace(table, rows(spark, (1, 1, 1)).limit(0), AT, KEYS, replaced=["ano=2024/mes=1"])
    assert table.read().isEmpty() and table.current().number == 3


def test_no_rows_keep_the_old_table(spark, table):
    versions.replace(table, rows(spark, (1, 2024, 1)), AT)
    assert versions.replace(table, rows(spark, (1, 2024, 1)).limit(0), AT).status == "skipped"
    assert table.current().number == 1 and table.read().count() == 1


def test_the_plan_may_read_what_it_replaces(spark, table):
    versions.replace(table, rows(spark, (1, 2024, 1), (2, 2024, 2)), AT, KEYS)
    result = versions.replace(table, table.read().filter("id = 1"), AT, KEYS, {"top": F.max("id")})
    assert result.metrics == {"top": 1} and values(table.read(), "id") == [(1,)]


def test_files_are_written_once(spark, table):
    versions.replace(table, rows(spark, (1, 2024, 1)), AT)
    version = table.current()
    assert table._files.names(table.root) == ["_versions", version.folders[""]]


@pytest.mark.parametrize("step", ["write", "commit", "publish"])
def test_a_failure_at_any_step_leaves_the_old_table(spark, table, database, monkeypatch, step):
    versions.replace(table, rows(spark, (1, 2024, 1)), AT, KEYS)
    table.publish(database)
    new = rows(spark, (2, 2025, 1))
    if step == "write":
        new = new.withColumn("id", F.raise_error(F.lit("broken plan")).cast("int"))
    elif step == "commit":
        monkeypatch.setattr(versions.Files, "put_new", lambda *a: (_ for _ in ()).throw(OSError("disk")))
    else:
        monkeypatch.setattr(versions, "replace_view", lambda *a: (_ for _ in ()).throw(OSError("catalog")))
    with pytest.raises((PySparkException, Py4JJavaError, OSError)):
        versions.replace(table, new, AT, KEYS)
        table.publish(database)
    assert values(spark.table(f"{database}.t"), "id", "ano") == [(1, 2024)]
    monkeypatch.undo()
    versions.replace(table, rows(spark, (2, 2025, 1)), AT, KEYS)
    table.publish(database)
    assert values(spark.table(f"{database}.t"), "id", "ano") == [(2, 2025)]


def test_second_writer_of_two_fails_without_effect(spark, table):
    versions.replace(table, rows(spark, (1, 2024, 1)), AT, KEYS)
    base = table.current()
    one, two = (table.write(rows(spark, (n, 2024, 1)), KEYS, base=base) for n in (2, 3))
    one.commit(AT)
    with pytest.raises(Conflict, match="version 2"):
        two.commit(AT)
    assert values(table.read(), "id") == [(2,)]


def test_a_taken_name_is_never_written_over(table):
    path = table._record(7)
    assert table._files.put_new(path, "first") and not table._files.put_new(path, "second")
    assert table._files.read(path) == "first"
    assert table._files.names(f"{table.root}/_versions") == ["00000007.json"]


def test_new_columns_reach_the_catalog(spark, table, database):
    """Partitions from before have NULL there; a column that a batch lacks stays, and keeps its type."""
    versions.replace(table, rows(spark, (1, 2024, 1)), AT, KEYS)
    table.publish(database)
    more = rows(spark, (2, 2024, 2)).withColumn("canal", F.lit("web"))
    versions.replace(table, more, AT, KEYS, replaced=["ano=2024/mes=2"])
    table.publish(database)
    assert values(spark.sql(f"SELECT * FROM {database}.t"), "id", "canal", "mes") == [(1, None, 1), (2, "web", 2)]
    late = spark.createDataFrame([(3, 2024, 3)], "id long, ano int, mes int")
    versions.replace(table, late, AT, KEYS, replaced=[])
    assert dict(table.read().dtypes)["id"] == "int" and values(table.read(), "id", "canal") == [(1, None), (2, "web"), (3, None)]


def test_catalog_prunes_partitions(spark, table, database):
    versions.replace(table, rows(spark, (1, 2024, 1), (2, 2024, 2)), AT, KEYS)
    table.publish(database)
    plan = spark.table(f"{database}.t").filter("mes = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(mes" in plan
    assert values(spark.table(f"{database}.t").filter("mes = 2"), "id") == [(2,)]


def test_a_plain_table_gives_way(spark, table, database, tmp_path):
    spark.sql(f"CREATE DATABASE {database}")
    spark.range(3).write.parquet(f"{tmp_path}/old")
    spark.catalog.createTable(f"{database}.t", path=f"{tmp_path}/old", source="parquet")
    versions.replace(table, rows(spark, (1, 2024, 1)), AT)
    table.publish(database)
    assert spark.table(f"{database}.t").columns == ["id", "ano", "mes"]
    assert spark.read.parquet(f"{tmp_path}/old").count() == 3


def test_old_versions_expire(spark, table, database):
    for day in (1, 2, 3):
        versions.replace(table, rows(spark, (day, 2024, day)), dt.datetime(2025, 1, day), KEYS, replaced=[])
        table.publish(database)
    lost = table.write(rows(spark, (99, 2024, 9)), KEYS, base=table.version(1))
    coming = table.write(rows(spark, (4, 2024, 4)), KEYS, base=table.current(), replaced=[])
    assert table.expire(dt.datetime(2025, 1, 3), keep=1) == [next(iter(lost.version.folders.values()))]
    assert table.numbers() == [3] and values(table.read(), "id") == [(1,), (2,), (3,)]
    coming.commit(AT)
    assert table.read().count() == 4
    assert [t.name for t in spark.catalog.listTables(database) if not t.isTemporary] == ["t", "t__v2", "t__v3"]


def test_compaction_packs_small_files_only(spark, table):
    versions.replace(table, spark.range(100).withColumn("mes", F.col("id") % 2), AT, ["mes"])
    folder = f"{table.root}/{table.current().folders['mes=1']}/mes=1"
    spark.range(50).repartition(5).write.mode("append").parquet(folder)
    good = table.current().folders["mes=0"]
    assert table.compact(AT, 1 << 20) == ["mes=1"]
    assert table.current().folders["mes=0"] == good and table.current().folders["mes=1"] != good
    assert table.read().count() == 150 and table.compact(AT, 1 << 20) == []
