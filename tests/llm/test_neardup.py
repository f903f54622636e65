import random

import numpy as np
import pytest

from granary.llm import neardup
from granary.llm.components import components

SCHEMA = "doc_id long, text string, n_shingles string"


def brute_force(rows, width, percent=80):
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        sets[doc_id] = {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def family(rng, n_words, copies, changes):
    words = [f"w{rng.randrange(10**6)}" for _ in range(n_words)]
    out = [" ".join(words)]
    for _ in range(copies):
        other = list(words)
        for _ in range(changes):
            other[rng.randrange(len(other))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(other))
    return out


@pytest.mark.parametrize("width", [4, 5])
def test_equals_brute_force(spark, width):
    rng = random.Random(width)
    texts = []
    for n in range(12):
        texts += family(rng, rng.choice([4, 9, 30, 120]), 6, rng.choice([0, 1, 2, 4]))
    texts += ["", None, " \t\n", "Eins", "eins", "eins zwei", "EINS zwei\x0bdrei vier fünf", "eins zwei drei vier fünf"]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 10))
    frame = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)
    found = {r["doc_id"]: r for r in neardup.near_duplicates(frame, neardup.Settings(width=width)).collect()}
    for doc_id, (size, component) in brute_force(rows, width).items():
        assert (found[doc_id]["n_shingles"], found[doc_id]["component_id"], found[doc_id]["kept"]) == (size, component, doc_id == component)


def test_chain_across_hubs(spark):
    """Links between two rows that both differ from a bucket's hub are found."""
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base[:i] + [f"y{j}" for j in range(i)] + base[2 * i :]) for i in (0, 3, 6, 9, 12, 15, 18, 21, 24)]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(frame, neardup.Settings(width=4)).collect()}
    assert found == {d: c for d, (_, c) in brute_force(rows, 4).items()}


def test_repeated_rows_null_ids_and_no_rows(spark):
    same, other = "a b c d e f g", "h i j k l m n"
    frame = spark.createDataFrame([(1, same), (1, same), (None, same), (3, same), (3, other), (2, other), (None, None)], "doc_id long, text string")
    rows = sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in neardup.near_duplicates(frame).collect())
    assert rows == [(-1, -1, True), (-1, -1, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (3, 1, False)]
    assert neardup.near_duplicates(frame.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    n = 60
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (5, 5)], "u long, v long")
    assert {r["vertex"]: r["root"] for r in components(edges).collect()} == {**dict.fromkeys(range(n + 1), 0), 100: 100, 101: 100}


def test_estimate_is_close(spark):
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 2**63, 800, dtype=np.uint64)
    sets = [np.unique(np.concatenate([shared, rng.integers(0, 2**63, 100, dtype=np.uint64)])) for _ in range(2)]
    bits = neardup.packed_bits(neardup.minima(sets, 512)).view(np.int64).tolist()
    frame = spark.createDataFrame([(bits[0], bits[1])], "a array<long>, b array<long>")
    estimate = frame.select(neardup.estimated(frame.a, frame.b, 512)).first()[0]
    assert abs(estimate - 0.8) < 0.1


def test_very_long_text(spark):
    long = " ".join(f"t{i % 50021}" for i in range(300_000))
    frame = spark.createDataFrame([(1, long), (2, long + " end")], "doc_id long, text string")
    assert [r["component_id"] for r in neardup.near_duplicates(frame).orderBy("doc_id").collect()] == [1, 1]


@pytest.mark.parametrize("shared, whole", [(4, 5), (8, 10)])
def test_short_texts_at_the_threshold_pass_the_estimate(shared, whole):
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(5_000):
        long = rng.integers(0, 2**63, whole, dtype=np.uint64)
        sets += [np.sort(long[:shared]), np.sort(long)]
    bits = neardup.packed_bits(neardup.minima(sets, 512))
    differ = bits[0::2] ^ bits[1::2]
    wrong = np.bitwise_count((differ | (differ >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=1)
    assert (((1 - wrong / 512 - 0.25) / 0.75) >= neardup.Settings().least_estimate).all()


def test_documents_just_below_the_threshold_hand_over_few_links(spark, monkeypatch):
    """Alike at about 0.76, with some links among them: what leaves the blocks is no more than the documents."""
    rng = random.Random(9)
    base, count = [f"w{i}" for i in range(260)], 150
    texts = []
    for _ in range(count):
        own = list(base)
        for place in rng.sample(range(260), rng.choice([5, 7, 9])):
            own[place] = f"x{rng.randrange(10**9)}"
        texts.append(" ".join(own))
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    handed, original = [], neardup._across

    def counted(*arguments):
        out = original(*arguments)
        handed.append(out.count())
        return out

    monkeypatch.setattr(neardup, "_across", counted)
    monkeypatch.setattr(neardup, "MEMBERS", 20)
    found = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(frame, neardup.Settings(width=4)).collect()}
    assert found == {d: c for d, (_, c) in brute_force(rows, 4).items()}
    assert handed[0] < 5 * count
