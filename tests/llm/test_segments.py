import math
import random

import numpy as np
import pytest

from granary.llm import segments

SCHEMA = "vec_id long, embedding array<double>, rank string, score string, x string, own string, class_id string, place string"


def run(spark, rows, every=5, use=segments.Settings()):
    frame = spark.createDataFrame([(i, v, *["clash"] * 6) for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in segments.top_products(frame, every, use).select("query_id", "rank", "vec_id", "score").collect()), key=repr)


def brute_force(rows, every=5, k=5):
    """Python's own integers, every pair."""
    whole = set()
    for i, v in rows:
        if i is not None and v and all(c is not None and math.isfinite(256 * c) for c in v):
            whole.add((i, tuple(math.floor(256 * c) for c in v)))
    answer = []
    for i, q in whole:
        if i % every == 0:
            others = [(sum(a * b for a, b in zip(q, x)), j, x) for j, x in whole if (j, x) != (i, q) and len(x) == len(q)]
            best = sorted(others, key=lambda o: (-o[0], o[1]))[:k]
            answer += [(i, n, j, max(-(2**63), min(2**63 - 1, s))) for n, (s, j, _) in enumerate(best, 1)]
    return sorted(answer, key=repr)


def vectors(count, size, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1) for _ in range(size)]) for i in range(count)]


@pytest.mark.parametrize("size", [1, 2, 5, 64, 100])
def test_equals_brute_force(spark, size):
    rows = vectors(200, size)
    assert run(spark, rows) == brute_force(rows)


def test_small_shells_and_groups_change_nothing(spark):
    """Four shells, several groups of queries, blocks that do not come out even."""
    rows = vectors(400, 24)
    use = segments.Settings(first_shell=2, growth=6, group_bytes=4000, rows=7, queries=3)
    assert run(spark, rows, use=use) == brute_force(rows)


def test_ties_go_to_smaller_ids_and_a_common_vector_is_no_trouble(spark):
    rng = random.Random(3)
    rows = [(i, [1.0, 0.5, -0.25] if i % 3 else [rng.random() for _ in range(3)]) for i in range(300)]
    use = segments.Settings(first_shell=10, growth=4)
    assert run(spark, rows, use=use) == brute_force(rows)


def test_odd_rows(spark):
    """NULLs, non-finite parts, empty, zero and short vectors, repeated rows, one id with two vectors, -0.0."""
    rows = vectors(30, 4) + [
        (5, None), (10, []), (15, [1.0, None, 1.0, 1.0]), (20, [math.nan, 1.0, 1.0, 1.0]), (25, [math.inf, 1.0, 1.0, 1.0]), (None, [1.0] * 4),
        (35, [0.0] * 4), (40, [-0.0, 1.0, 0.0, 1.0]), (40, [-0.0, 1.0, 0.0, 1.0]), (40, [0.0, 1.0, 0.0, 1.0]), (5, [2.0] * 4), (50, [1.0, 2.0]), (51, [3.0, 4.0]), (55, [1.0] * 7),
    ]
    found = run(spark, rows)
    assert found == brute_force(rows)
    assert (50, 1, 51, 256 * 256 * 11) in found and not any(q == 55 for q, *_ in found)


def test_scores_beyond_doubles_and_longs(spark):
    rng = random.Random(7)
    rows = [(i, [rng.choice([1e9, 3e9, -2e9, 1e-3]) + rng.random() for _ in range(6)]) for i in range(60)]
    rows += [(100, [1e30, 1.0, 1.0, 1.0, 1.0, 1.0]), (105, [1e300, 0.0, 0.0, 0.0, 0.0, 0.0])]
    use = segments.Settings(first_shell=8, growth=3)
    assert [r for r in run(spark, rows, use=use) if abs(r[3]) < 2**62] == [r for r in brute_force(rows) if abs(r[3]) < 2**62]


def test_empty_table(spark):
    assert run(spark, []) == [] and run(spark, [(1, [1.0])]) == [] and run(spark, [(5, [1.0])]) == []


def test_bounds_are_bounds():
    rng = np.random.default_rng(2)
    for size in (7, 33, 64):
        a, b = rng.normal(size=(2, 50, size))
        exact = a @ b.T
        before = np.full(exact.shape, np.inf)
        for count in segments.resolutions(size):
            bound = segments.description(a, count) @ segments.description(b, count).T
            assert (bound >= exact - 1e-9).all()
            if size == 64:
                assert (bound <= before + 1e-9).all()
            before = bound
