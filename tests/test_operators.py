import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from granary.operators import integrity
from granary.operators.dedup import latest_by_key
from granary.operators.quantiles import exact_quantiles
from granary.operators.upsert import touched_partitions, upsert
from granary.plans import quality
from tests.rows import values


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    frame.collect()
    return plan_of(frame)


def test_latest_by_key(spark):
    frame = spark.createDataFrame(
        [(1, "old", 1, 5), (1, "new", 2, 1), (2, "only", None, 1), (1, "undated", None, 9)],
        "id int, name string, version int, day int",
    )
    got = latest_by_key(frame, ["id"], ["version", "day"])
    assert got.columns == frame.columns
    assert values(got, *got.columns) == [(1, "new", 2, 1), (2, "only", None, 1)]


def test_latest_by_key_reduces_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    plan = plan_of(latest_by_key(frame, ["k"], ["v"]))
    assert "partial_max" in plan and "Window" not in plan


@pytest.mark.parametrize("bracket_values", [100_000, 50])
def test_exact_quantiles_equal_the_exact_percentile(spark, bracket_values):
    rng = random.Random(3)
    rows = [("hot", float(rng.choice([0, 1, rng.gauss(50, 20), rng.random() * 1e6]))) for _ in range(5000)]
    rows += [("tiny", 4.0), ("tiny", 8.0), ("one", -2.5), ("none", None), ("same", 7.0), ("same", 7.0)]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(7)
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = dict(values(exact_quantiles(frame, ["g"], "v", probabilities, bracket_values), "g", "quantis"))
    wanted = frame.filter("v is not null").groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, probabilities))))
    assert set(got) == {"hot", "tiny", "one", "same"}
    for group, expected in wanted.collect():
        assert got[group] == pytest.approx(expected, rel=1e-12)


def test_exact_quantiles_without_groups(spark):
    frame = spark.range(1, 1001).select(F.col("id").cast("double").alias("v"))
    for limit in (10, 100_000):
        assert exact_quantiles(frame, [], "v", [0.25, 0.5], limit).first()["quantis"] == [250.75, 500.5]


def test_rows_without_a_group_are_a_group(spark):
    frame = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    assert {r["g"]: r["quantis"] for r in exact_quantiles(frame, ["g"], "v", [0.5]).collect()} == {None: [2.0], "a": [5.0]}
    fenced = quality.outliers_iqr(frame, "g", "v")
    assert fenced.count() == 3 and fenced.filter("limite_inferior IS NULL").isEmpty()


def test_upsert_twice_changes_nothing(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    batch = spark.createDataFrame([("x", 1), ("y", 3)], "v string, id int")
    once = upsert(old, batch, ["id"])
    assert values(once, "id", "v") == [(1, "x"), (2, "c"), (3, "y")]
    assert values(upsert(once, batch, ["id"]), "id", "v") == values(once, "id", "v")


def test_upsert_can_remove_a_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "c")], "id int, v string")
    none = spark.createDataFrame([], "id int, v string")
    gone = spark.createDataFrame([(2,)], "id int")
    assert values(upsert(old, none, ["id"], gone), "id") == [(1,)]


def test_touched_partitions_include_the_old_place(spark):
    old = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "id int, day int")
    batch = spark.createDataFrame([(1, 9)], "id int, day int")
    assert values(touched_partitions(old, batch, batch, ["id"], ["day"]), "day") == [(5,), (9,)]


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (8,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    report = integrity.orphan_report([("a", child, "fk", parent, "id"), ("b", parent, "id", parent, "id")])
    assert values(report, *report.columns) == [("a", 3, 2), ("b", 0, 0)]


def test_null_counts(spark):
    frame = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    got = integrity.null_counts("t", frame, ["a", "b"])
    assert values(got, *got.columns) == [("t", "a", 1, 2), ("t", "b", 2, 2)]


def test_conversion(spark):
    frame = spark.createDataFrame([("1", "2025-01-01"), ("x", "never"), (None, None)], "n string, t string")
    targets = {"n": "int", "t": "date"}
    assert values(quality.convert_types(frame, targets), "n", "t") == [
        (1, dt.date(2025, 1, 1)), (None, None), (None, None),
    ]
    report = quality.conversion_report(frame, targets)
    assert values(report, *report.columns) == [("n", "int", 3, 1, 1, 1), ("t", "date", 3, 1, 1, 1)]


def test_outliers(spark):
    frame = spark.createDataFrame(
        [("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("b", None)], "g string, v double"
    )
    got = quality.outliers_iqr(frame, "g", "v")
    assert values(got, "v", "atipico", "valor_ajustado") == [
        (1.0, False, 1.0), (100.0, True, 7.0), (2.0, False, 2.0), (3.0, False, 3.0), (4.0, False, 4.0),
        (None, None, None),
    ]


def test_hot_join_key_is_split(spark):
    """A sale with most of the lines: its partition is read by several tasks."""
    from granary.session import settings

    lines = spark.range(200_000).select(
        F.when(F.col("id") % 10 < 8, 7).otherwise(F.col("id")).alias("venda_id"),
        F.repeat(F.col("id").cast("string"), 4).alias("x"),
    ).repartition(20)
    sales = spark.range(200_000).select(F.col("id").alias("venda_id"), (F.col("id") * 2).alias("y"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    with settings(spark, small):
        joined = lines.join(sales, "venda_id")
        assert "skew=true" in final_plan(joined)
        assert joined.count() == 200_000
