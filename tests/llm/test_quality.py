import zlib

import numpy as np

from granary.llm import quality
from granary.llm.common import table


def test_tables_learn_a_sum_and_a_pair():
    rng = np.random.default_rng(5)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0.6)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.93
    assert (0, 1) in {tuple(sorted(p[:2])) for p in model.pair_tables}


def test_score_is_a_sum_of_table_entries():
    rng = np.random.default_rng(6)
    x = rng.random((500, 3))
    model = quality.fit(x, (x[:, 2] > 0.5).astype(float), quality.Settings(rounds=20, pair_rounds=5))
    row = x[7]
    total = model.base + sum(t[np.searchsorted(e, v, "right")] for t, e, v in zip(model.tables, model.edges, row))
    total += sum(t[np.searchsorted(model.pair_edges[a], row[a], "right"), np.searchsorted(model.pair_edges[b], row[b], "right")] for a, b, t in model.pair_tables)
    assert np.isclose(model.score(row[None])[0], 1 / (1 + np.exp(-total)))


def test_held_out_accuracy(spark, folder):
    docs, labels = table(spark, folder.replace("sf0.001", "sf0.01"), "documents"), table(spark, folder.replace("sf0.001", "sf0.01"), "labels")
    rows = quality.score(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [(r["score"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum((s >= 0.5) == bool(q) for s, q in held) / len(held) > 0.95
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "x " * 100_000), (3, "x y"), (4, "\n\n \t")]
    docs = spark.createDataFrame([(i, t, 9.0) for i, t in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1), (7, 1)], "doc_id long, quality int")
    found = quality.score(docs, labels).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(i) for i, _ in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    assert quality.score(docs.limit(0), labels.limit(0)).count() == 0
