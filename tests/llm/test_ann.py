import numpy as np

from granary.llm import ann
from granary.llm.common import table


def brute_force(rows, every, k):
    """(query, rank) -> (vec_id, distance)."""
    ids = np.array([i for i, _ in rows])
    x = np.array([np.float64(v) for _, v in rows])
    out = {}
    for q in sorted({i for i in ids.tolist() if i % every == 0}):
        far = np.sqrt(((x - x[np.flatnonzero(ids == q)[0]]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, far)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(far[j])) for j in order]
    return out


def answers(frame, **kw):
    out = {}
    for r in sorted(ann.nearest(frame, **kw).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(found, want):
    hits = [len({i for i, _ in found.get(q, [])} & {i for i, _ in w}) / len(w) for q, w in want.items()]
    return np.mean(hits)


def test_recall_on_all_vectors(spark, folder):
    frame = table(spark, folder.replace("sf0.001", "sf0.1"), "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    want, found = brute_force(rows, 100, 10), answers(frame)
    assert set(found) == set(want) and all(len(v) == 10 for v in found.values())
    assert recall(found, want) >= 0.9
    by_id = dict(rows)
    for q, near in list(found.items())[:5]:
        for i, score in near:
            assert score == np.sqrt(((np.float64(by_id[i]) - np.float64(by_id[q])) ** 2).sum())


def test_equal_vectors_and_ties(spark):
    hot = [1.0, 0.0, 0.0, 0.0]
    rows = [(i, hot) for i in range(0, 60)] + [(i, [0.0, 1.0, 0.0, 0.0]) for i in range(100, 105)] + [(200, [0.0, 0.0, 1.0, 0.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    use = ann.Settings(bucket=1000)
    found = answers(frame, every=10, use=use)
    assert found == brute_force(rows, 10, 10)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (8, [1.0]), (None, [1.0, 2.0]), (1, [1.0, 2.5]), (100, [0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert answers(frame) == {0: [(1, 0.5)]}
    assert ann.nearest(frame.limit(0)).count() == 0


def test_hash_is_the_nearest_signed_axis():
    hasher = ann.Hasher(64, 2, 128, 3)
    x = ann.unit_vectors(np.random.default_rng(2).normal(size=(50, 64)))
    y = hasher.rotated(x, 1, 0)
    assert np.allclose(np.linalg.norm(y, axis=1), 1, atol=1e-4)
    axes = np.concatenate([y, -y], 1)
    assert (hasher.ranked(x, 1, 5)[:, 0] == axes.argmax(1)).all()


def test_rounds_and_blocks_lose_nothing(spark, monkeypatch):
    """With every bucket probed, the rounds give the exact answer, ties in distance included."""
    monkeypatch.setattr(ann, "probes_for", lambda hasher, *_: hasher.buckets)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.integers(-2, 3, (900, 6))) if v.any()]
    rows += [(2000 + i, [float(i == j) for j in range(6)]) for i in range(6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for use in (ann.Settings(), ann.Settings(bucket=10, growth=2, block=7, slice=3)):
        assert answers(frame, every=50, use=use) == brute_force(rows, 50, 10)


def test_a_round_lets_out_few_rows_whatever_it_looks_into():
    import pandas as pd

    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 16))
    rows = pd.DataFrame({"class_id": range(3000), "first_id": range(3000), "v": list(x)})
    queries = pd.DataFrame({"class_id": range(5), "v": list(x[:5]), "bound": np.inf})
    first = ann._compare(queries, rows.iloc[:300], ann.Settings())
    assert len(first) == 5 * 11
    bounds = first.groupby("q")["score"].max()
    later = ann._compare(queries.assign(bound=bounds.to_numpy()), rows.iloc[300:], ann.Settings())
    assert len(later) <= 5 * 11 and (later["score"].to_numpy() <= bounds[later["q"]].to_numpy()).all()
    # Equal distances do not add rows, and numbers whose squares overflow are compared all the same.
    same = pd.DataFrame({"class_id": range(100), "first_id": range(100), "v": [[0.0, 1.0]] * 100})
    assert ann._compare(pd.DataFrame({"class_id": [1], "v": [[1.0, 0.0]], "bound": [np.inf]}), same, ann.Settings())["class_id"].tolist() == list(range(11))
