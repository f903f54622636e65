"""Rows among many ids, stored frames, and what an incremental load moves."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from granary.operators.members import Ids, Values
from granary.plans import incremental, lattice, rules, totals
from granary.plans.arrivals import staged
from granary.session import settings
from granary.sinks import lake, versions
from granary.sinks.lake import stage
from granary.sinks.versions import VersionedTable
from tests.rows import bronze, values

# As at a size where the other side of a join is too large to broadcast.
LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
AT = dt.datetime(2025, 3, 9, 4)


def executed(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most", [1_000, 0])
def test_ids_choose_as_semi_and_anti_joins_do(spark, most):
    numbers = [-(2**63), -65, -64, -1, 0, 1, 63, 64, 2**63 - 1]
    ids = spark.createDataFrame([(n,) for n in [*numbers[::2], 1, 1, None]], "id long")
    rows = spark.createDataFrame([(n, c) for n in [*numbers, None] for c in "ab"], "venda_id long, c string")
    chosen = Ids.of(ids, most)
    assert (chosen.words is None) == (most == 0)
    for own, how in ((chosen.among, "left_semi"), (chosen.without, "left_anti")):
        expected = rows.join(ids.toDF("venda_id"), "venda_id", how)
        assert values(own(rows, "venda_id"), "venda_id", "c") == values(expected, "venda_id", "c")


def test_many_ids_move_no_rows(spark):
    """However many sales have changed, the old lines and the new extract are not dealt out by sale."""
    chosen = Ids.of(spark.range(0, 100_000, 2).toDF("venda_id"))
    rows = spark.range(200_000).toDF("venda_id")
    with settings(spark, LARGE):
        for frame, expected in ((chosen.among(rows, "venda_id"), 50_000), (chosen.without(rows, "venda_id"), 150_000)):
            assert frame.count() == expected
            assert "hashpartitioning" not in executed(frame)


def test_stored_frames_are_written_as_they_lie(spark):
    frame, result = stage(spark.range(0, 100, 1, 3).toDF("id"), "as-they-lie")
    assert result.rows == 100 and len(frame.inputFiles()) == 3


def test_few_refused_lines_leave_the_others_in_place(spark):
    """Stored first, the refused lines are known to be few; neither all lines nor all headers are shuffled to meet them."""
    sales = bronze(spark, "vendas", {"id": 1}, {"id": 2, "cliente_id": None}, {"id": 3})
    lines = bronze(spark, "itens_venda", {"id": 1, "venda_id": 1}, {"id": 2, "venda_id": 2}, {"id": 3, "venda_id": 3, "quantidade": 0}, {"id": 4, "venda_id": 9, "quantidade": 0})
    sales, lines = sales.filter(F.rand(1) >= 0), lines.filter(F.rand(1) >= 0)
    found = rules.refused_lines(staged(sales, "sales"), staged(lines, "lines"), lambda some: staged(some, "refused"))
    plain = rules.refused_lines(sales, lines)
    assert values(found, "item_venda_id", "motivos") == values(plain, "item_venda_id", "motivos")
    assert [r[0] for r in values(found, "item_venda_id")] == [2, 3]
    assert "SortMergeJoin" not in executed(found)


NUMBERS = [-(2**63), -65, -64, -1, 0, 1, 5, 63, 64, 2**63 - 1]


@pytest.mark.parametrize("twice", [[], [(5, 7)]])
def test_values_are_found_as_by_a_join(spark, twice):
    """Ids that have no value, NULL as a value, NULL as an id, and an id that comes twice."""
    pairs = spark.createDataFrame([*[(n, None if n == 63 else n % 10) for n in NUMBERS[1:]], (None, 3), *twice], "id long, kind long")
    rows = spark.createDataFrame([(n, c) for n in [*NUMBERS, 2, None] for c in "ab"], "produto_id long, c string")
    packed = Values.of(pairs)
    assert (packed.words is None) == bool(twice) and Values.of(pairs, 0).words is None
    expected = rows.join(pairs.toDF("produto_id", "kind"), "produto_id")
    assert values(packed.joined(rows, "produto_id", "kind"), "produto_id", "c", "kind") == values(expected, "produto_id", "c", "kind")


@pytest.fixture
def months(spark, bed, tmp_path):
    from granary.catalogue import base

    table = VersionedTable(spark, str(tmp_path), "facts_vendas")
    versions.replace(table, base.facts(bed).filter("ano >= 2001 OR mes = 1"), AT, ["ano", "mes"])
    return table, base.products(bed)


def test_stored_totals_move_no_lines(spark, months, tmp_path, monkeypatch):
    """The lines of a month lie together; neither grouping nor writing deals them out, nor does looking up their categories."""
    table, goods = months
    plans, save = [], versions.save_observed

    def spy(frame, *more, **named):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return save(frame, *more, **named)

    monkeypatch.setattr(versions, "save_observed", spy)
    with settings(spark, LARGE):
        found = lattice.refresh(spark, str(tmp_path), table, goods, AT, incremental=True)
        totals.refresh(spark, str(tmp_path), table, AT, incremental=True)
    assert len(plans) == 6 and not [p for p in plans if "hashpartitioning" in p]
    assert found.lines.agg(F.sum("linhas")).first()[0] == table.read().count()


@pytest.mark.parametrize("limits", [{"LEAST_BYTES": 1}, {"TASK_BYTES": 1, "WHOLE_BYTES": 12_500}, {"WHOLE_BYTES": 0}, {"LEAST_BYTES": 1, "ALL_BYTES": 70_000}])
def test_whole_partitions_add_up_as_the_table_does(spark, months, tmp_path, monkeypatch, limits):
    """In one task or many, and with months that are too large for a task."""
    table, goods = months
    for name, value in limits.items():
        monkeypatch.setattr(versions, name, value)
    small, large = table.read_whole()
    assert (large is None) == (limits == {"LEAST_BYTES": 1}) and (len(small) > 1) == (limits != {"WHOLE_BYTES": 0})
    counted = [f.select("ano", "mes").distinct().count() for f in [*small, *([large] if large is not None else [])]]
    assert sum(counted) == len(table.current().folders)
    kinds = Values.of(goods.select("produto_id", "categoria_id"))
    for build in (lattice.sale_days, lattice.line_days, lambda f: lattice.kind_days(f, kinds), totals.product_days, totals.customer_days):
        stored = totals.bring_up(spark, str(tmp_path / uuid.uuid4().hex), table, AT, False, "t", build)
        assert values(stored, *sorted(stored.columns)) == values(build(table.read()), *sorted(stored.columns))


def test_frames_of_one_task_each_are_written_by_as_many(spark, tmp_path):
    frames = [spark.range(n, n + 5).coalesce(1) for n in range(3)]
    lake.save_observed(frames[0].union(frames[1]).union(frames[2]), str(tmp_path / "t"), [], {}, in_place=True)
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 3


def test_a_batch_by_partition_replaces_sales_in_place(spark, tmp_path):
    table, keys = VersionedTable(spark, str(tmp_path), "t"), ["ano", "mes"]
    rows = lambda *data: spark.createDataFrame(list(data), "venda_id long, ano int, mes int, x int")
    versions.replace(table, rows((1, 2024, 1, 1), (2, 2024, 1, 1), (3, 2024, 2, 1), (4, 2024, 3, 1)), AT, keys)
    days = [{"ano": 2024, "mes": m} for m in (1, 2)]
    draft, _ = incremental.load_facts(table, table.current(), rows((1, 2024, 2, 2)), rows((1, 0, 0, 0), (3, 0, 0, 0)).select("venda_id"), days, in_place=True)
    draft.commit(AT)
    assert values(table.read(), "venda_id", "mes", "x") == [(1, 2, 2), (2, 1, 1), (4, 3, 1)]
