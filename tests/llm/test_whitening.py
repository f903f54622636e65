import math

import numpy as np
import pytest

from granary.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n string, index string, x string, component string"


def run(spark, rows, use=whitening.Settings()):
    frame = spark.createDataFrame([(i, v, *["clash"] * 4) for i, v in rows], SCHEMA)
    return whitening.whiten(frame, use).toPandas()


def held_against_loops(found, rows):
    """Every column against whole numbers in Python and one dense decomposition."""
    whole = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows]
    n, size = len(whole), len(whole[0])
    sums = [sum(x[d] for x in whole) for d in range(size)]
    moved = [[n * x[d] - sums[d] for d in range(size)] for x in whole]
    deviation = [sum(m * m for m in row) for row in moved]
    centred = np.array(moved, float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    keep = [i for i in range(size)[::-1] if values[i] > 1e-9][:32]
    z = centred @ vectors[:, keep] / np.sqrt(values[keep])
    assert len(found) == n * len(keep)
    assert (found["n"] == n).all() and (found["identity_error"] < 1e-6).all() and found["identity_error"].nunique() == 1
    wide = found.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in rows]].to_numpy()
    sign = np.sign((wide * z).sum(0))
    assert np.allclose(wide, z * sign, atol=1e-7)
    of = found.drop_duplicates("vec_id").set_index("vec_id")["deviation"]
    assert [int(of[i]) for i, _ in rows] == deviation
    share = found.drop_duplicates("component").set_index("component")["explained"].sort_index().to_numpy()
    assert np.allclose(share, values[keep] / values.sum(), rtol=1e-8)


def vectors(count, size, seed=1):
    rng = np.random.default_rng(seed)
    scale = np.linspace(0.2, 9, size)
    return [(i, (rng.normal(size=size) * scale + 30).tolist()) for i in range(count)]


@pytest.mark.parametrize("count, size", [(300, 40), (500, 3), (10, 16)])
def test_equals_dense_computation(spark, count, size):
    rows = vectors(count, size)
    held_against_loops(run(spark, rows), rows)


def test_many_blocks_and_splits(spark):
    rows = vectors(400, 8)
    held_against_loops(run(spark, rows, whitening.Settings(numbers=40, blocks=3)), rows)


def test_a_common_vector(spark):
    rows = vectors(60, 5) + [(100 + i, [1.0, 2.0, 3.0, 4.0, 5.0]) for i in range(40)]
    held_against_loops(run(spark, rows), rows)


def test_odd_rows_take_no_part(spark):
    rows = vectors(50, 4)
    odd = [(90, None), (91, []), (92, [1.0, None, 1.0, 1.0]), (93, [math.nan] * 4), (94, [math.inf, 1.0, 1.0, 1.0]), (95, [1.0, 2.0]), (96, [3e38, 0.0, 0.0, 0.0])]
    held_against_loops(run(spark, rows + odd), rows)


def test_repeated_and_null_ids_count_each(spark):
    rows = vectors(30, 3) + [(None, [1.0, 2.0, 9.0]), (3, [5.0, 5.0, 5.0]), (3, [5.0, 5.0, 5.0])]
    found = run(spark, rows)
    assert len(found) == 33 * 3 and (found["n"] == 33).all()


def test_nothing_to_whiten(spark):
    assert len(run(spark, [])) == 0
    assert len(run(spark, [(1, [1.0, 2.0])])) == 0
    assert len(run(spark, [(i, [1.0, 2.0]) for i in range(9)])) == 0
    assert run(spark, []).columns.tolist() == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries(spark):
    """A deviation that no long can hold is NULL."""
    rows = [(i, [float(i) * 1e9, float(i % 2)]) for i in range(20)]
    found = run(spark, rows)
    assert found["deviation"].isna().any() and (found["identity_error"] < 1e-4).all()


def test_whole_table(spark, folder):
    """The registered query's rows on the test table."""
    from granary.llm.queries import QUERIES

    table = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    held_against_loops(QUERIES["op13_block_whitening"](spark, folder).toPandas(), [tuple(r) for r in table])
