import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from granary.llm import mixing


@given(st.dictionaries(st.text("abc", min_size=1, max_size=3), st.floats(0.001, 1000), min_size=1, max_size=12))
@settings(max_examples=60, deadline=None)
def test_deviation_stays_below_one_block(weights):
    shares = mixing.whole_shares(weights, 100)
    assert sum(shares.values()) == 100 and min(shares.values()) >= 1
    slots = mixing.pattern(shares)
    assert sorted(x for own in slots.values() for x in own) == list(range(100))
    for source, own in slots.items():
        for t in range(1, 101):
            assert abs(sum(s < t for s in own) - t * shares[source] / 100) < 1


def rows_of(rng, n):
    return [(i, "x" * rng.randrange(0, 60), rng.choice(["a"] * 8 + ["b", "b", "c", None])) for i in range(n)]


def test_equals_a_slot_by_slot_schedule(spark):
    rows = rows_of(random.Random(2), 400)
    use = mixing.Settings(block=100, period=20, bucket_rows=30)
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), use=use).collect()
    assert {r["doc_id"] for r in found} == {r[0] for r in rows}
    # Blocks in turn from the pattern, until every source has been through once.
    size = Counter()
    for _, text, source in rows:
        size[source or ""] += max(1, len(text))
    blocks = {s: -(-n // 100) for s, n in size.items()}
    shares = mixing.whole_shares({s: n**0.7 for s, n in size.items()}, 20)
    order = {slot: s for s, own in mixing.pattern(shares).items() for slot in own}
    given_out, slot, want = Counter(), 0, {}
    while any(given_out[s] < blocks[s] for s in blocks):
        s = order[slot % 20]
        want[slot] = (s, given_out[s] // blocks[s], given_out[s] % blocks[s])
        given_out[s] += 1
        slot += 1
    for r in found:
        assert want[r["slot"]] == (r["source"] or "", r["pass"], r["block"])
    # Each pass holds the same documents in the same blocks.
    homes = {}
    for r in found:
        homes.setdefault((r["doc_id"], r["pass"]), []).append(r["block"])
    assert all(len(b) == 1 for b in homes.values())
    assert all(homes[d, 0] == b for (d, _), b in homes.items())
    whole = Counter((r["source"] or "", r["pass"], r["block"]) for r in found)
    assert all(n > 0 for n in whole.values())


def test_given_weights_and_odd_rows(spark):
    rows = [(1, None, "a"), (1, None, "a"), (2, "", "a"), (None, "x", "b"), (3, "y" * 100_000, "b")]
    frame = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, slot int")
    found = mixing.mix(frame, {"a": 1, "b": 3})
    assert Counter(r["doc_id"] for r in found.filter("pass = 0").collect()) == Counter(r[0] for r in rows)
    assert mixing.in_order(found).columns == ["doc_id", "text", "source"]
    with pytest.raises(KeyError):
        mixing.mix(frame, {"a": 1})
    assert mixing.mix(frame.limit(0)).count() == 0


def test_shares_are_the_weights():
    assert mixing.whole_shares({"a": 0.9, "b": 0.1}, 1000) == {"a": 900, "b": 100}
    many = {f"s{i}": 1 for i in range(999)} | {"big": 999 / 2}
    assert abs(mixing.whole_shares(many, 3000)["big"] - 1000) < 1


@pytest.mark.parametrize("sources", [2, 20, 1000])
def test_deviation_from_the_weights_stays_below_one_block(sources):
    rng = random.Random(sources)
    weights = {f"s{i}": rng.random() + 0.01 for i in range(1, sources)}
    weights["big"] = sum(weights.values()) / 2  # a third of all
    period, slots = mixing.schedule(weights, {s: 40_000 if s == "big" else 1 for s in weights}, mixing.Settings())
    total = sum(weights.values())
    assert len(slots["big"]) >= 40_000
    for s, own in slots.items():
        for i, slot in enumerate(own):
            assert abs(i - slot * weights[s] / total) < 1 + 1e-6 and abs(i + 1 - (slot + 1) * weights[s] / total) < 1 + 1e-6


def test_more_slots_than_the_table_holds(spark):
    rows = [(i, "x" * 10, "a" if i % 10 else "b") for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for use in (mixing.Settings(block=10), mixing.Settings(block=10, most_slots=70)):
        found = mixing.mix(frame, {"a": 0.7, "b": 0.3}, use).collect()
        assert Counter(r["slot"] for r in found) == Counter(range(len(found)))
        assert {r["doc_id"] for r in found} == set(range(600))
        given_out = 0
        for n, r in enumerate(sorted(found, key=lambda r: r["slot"]), 1):
            given_out += r["source"] == "b"
            assert abs(given_out - 0.3 * n) < 1 + 1e-6
