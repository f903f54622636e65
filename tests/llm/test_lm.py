import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from granary import session
from granary.llm import lm
from granary.llm.common import table


def tokens(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", text), None]


def base_by_hand(rows):
    learnt = Counter(t for i, text in rows if i is None or zlib.crc32(str(i).encode()) % 5 != 1 for t in tokens(text))
    n, v = sum(learnt.values()), len(learnt)
    return n, [(len(own := tokens(text)), sum(learnt[t] > 0 for t in own), sum(math.log10((learnt[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)) for _, text in rows]


@pytest.mark.parametrize("head", [0, 3, 1 << 18])
def test_base_score_is_exact(spark, head):
    rows = [(i, f"The cat {i} sat on THE mat {'the ' * (i % 7)}\x0bÜber über") for i in range(40)] + [(41, None), (42, ""), (None, "cat cat"), (7, "cat x"), (7, "cat x"), (43, "word " * 70_000)]
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int")
    n, want = base_by_hand(rows)
    found = sorted(((r["n_tokens"], r["n_known"], r["base_score"]) for r in lm.score(frame, lm.Settings(head=head)).collect()))
    for a, b in zip(found, sorted(want)):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9)
    first = lm.score(frame, lm.Settings(head=head)).first()
    assert first["train_tokens"] == n and first["score"] < 0


def test_no_documents(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(frame).count() == 0
    only = spark.createDataFrame([(next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1), "a b")], "doc_id long, text string")
    row = lm.score(only).first()
    assert row["held_out"] and (row["n_known"], row["train_tokens"]) == (0, 0)


def test_filter_gives_levels_and_never_understates():
    rng = np.random.default_rng(8)
    grams = np.unique(rng.integers(0, 1 << 63, 60_000, dtype=np.uint64))
    times = rng.zipf(1.6, len(grams)).clip(1, 10**6)
    use = lm.Settings()
    head, tail = lm.fill_segment(grams, times, lm.SEGMENT_BITS, use)
    known = lm.Filter(head, 1, lm.SEGMENT_BITS, use.hashes)
    found, want = known.levels(grams), lm.levels_of(times)
    assert tail is None and (found >= want).all() and (found == want).mean() > 0.95
    assert (known.levels(rng.integers(0, 1 << 63, 50_000, dtype=np.uint64)) == 0).mean() > 0.95


def test_what_does_not_fit_into_the_head_is_in_the_tail():
    grams = np.arange(1, 600_001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    times = np.where(np.arange(600_000) < 10_000, 8, 1)
    head, tail = lm.fill_segment(grams, times, lm.SEGMENT_BITS, lm.Settings())
    found = lm.Filter(head, 1, lm.SEGMENT_BITS, 3).levels(grams)
    assert (found[:10_000] >= 4).all() and (found[10_000:] == 0).mean() > 0.95
    assert (lm.Filter(tail, 1, 8 * len(tail), 3).levels(grams[10_000:]) >= 1).all()


def model_by_hand(rows, prior):
    """The smoothed bigram model over exact counts, each brought down to a power of two."""
    ones, twos = Counter(), Counter()
    for i, text in rows:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            own = tokens(text)
            ones.update(own)
            twos.update(zip(["<start>", *own], own))
    low = lambda c: 2 ** int(math.log2(c)) if c else 0
    n, v = sum(ones.values()), len(ones)
    for _, text in rows:
        own, total = tokens(text), 0.0
        for a, b in zip(["<start>", *own], own):
            before, pair = low(ones[None] if a == "<start>" else ones[a]), low(twos[a, b])
            total += math.log10((pair + prior * (low(ones[b]) + 0.5) / (n + 0.5 * (v + 1))) / (max(before, pair) + prior))
        yield total


@pytest.mark.parametrize("more", [{}, {"head": 0}, {"head_bits": 1 << 10}, {"head_bits": 1 << 10, "head": 20, "slice": 3}, {"head_bits": 64, "head": 0}])
def test_score_equals_exact_counts_whatever_fits_into_the_head(spark, more):
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.8)) % 500}" for _ in range(rng.randrange(60)))) for i in range(150)]
    rows += [(200, None), (201, "never seen Words"), (None, "w1 w1"), (7, rows[7][1]), (202, "long " * 20_000)]
    use = lm.Settings(bits=256, **more)  # false positives are too rare to meet here
    found = sorted(r["score"] for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string"), use).collect())
    assert found == pytest.approx(sorted(model_by_hand(rows, use.prior)), rel=1e-9)


def test_segments_stay_few_and_bounded():
    use = lm.Settings()
    assert [lm.segments_for(n, use) for n in (0, 1, 131_072, 131_073, 100_000_000)] == [1, 1, 1, 2, 1024]
    assert lm.segments_for(1_400_000_000, use) == 1024
    assert 10**10 / lm.segments_for(10**10, use) <= lm.SEGMENT_TOKENS


def test_slices_are_bounded_by_bytes():
    texts = ["a" * 30, None, "", "b" * 200, "c" * 10, "d" * 95, *["e"] * 9]
    batch = pa.RecordBatch.from_pydict({"doc_id": [*range(len(texts))], "text": texts})
    parts = [part.column(1).to_pylist() for part in lm._slices(batch, 4, 100)]
    assert [text for part in parts for text in part] == texts
    assert [len(part) for part in parts] == [3, 1, 1, 4, 4, 2]


def test_texts_are_not_written_with_their_tokens(spark, tmp_path, monkeypatch):
    """Scratch files of a filter that does not fit into the head are about as large as those of one that does."""
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.6))}" for _ in range(300))) for i in range(600)]
    frame, written = spark.createDataFrame(rows, "doc_id long, text string"), {}
    for bits in (1 << 29, 1 << 12):
        folder = tmp_path / str(bits)
        monkeypatch.setattr(session, "scratch_root", lambda _: str(folder))  # noqa: B023
        assert lm.score(frame, lm.Settings(head_bits=bits, slice=100)).count() == 600
        written[bits] = sum(f.stat().st_size for f in folder.rglob("*.parquet"))
    assert written[1 << 12] < 1.3 * written[1 << 29]


def test_model_knows_prose_from_shuffled_words(spark, folder):
    docs = table(spark, folder.replace("sf0.001", "sf0.01"), "documents")
    rows = lm.score(docs).collect()
    held = [r for r in rows if r["held_out"] and r["n_tokens"] > 50]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert len(rows) == docs.count()
