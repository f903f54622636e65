import math
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from granary.llm import rules
from granary.llm.common import table


def counts_of(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {p for i, w in enumerate(windows) if often[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def hash64(*parts):
    """Chained 64-bit hashes of texts and of signed 64-bit numbers."""
    seed = 42
    for x in parts:
        seed = xxhash.xxh64_intdigest(x.encode() if isinstance(x, str) else struct.pack("<q", x), seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def grams(text, use):
    hashes = [hash64(w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    for i, h in enumerate(hashes):
        yield h % use.buckets
        yield hash64(*hashes[i : i + 2]) % use.buckets


TEXTS = [
    None,
    "",
    " \t\n\x0b",
    "one",
    "a b c a b c",
    "a a a a a a",
    "x y z\nx y z\n\n  \nx y z #*$%&|<>",
    "é ü\x85 a b c d",
    "the cat sat " * 30,
    " ".join(f"w{i}" for i in range(60)),
    "w " * 20_000,
]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, t, True) for i, t in enumerate(TEXTS)] + [(9, TEXTS[9], False), (None, TEXTS[9], None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept boolean")
    trusted = spark.createDataFrame([(9,), (3,), (3,), (None,)], "doc_id int")
    return rows, rules.judge(frame, trusted).collect()


def test_counts_equal_brute_force(judged):
    rows, found = judged
    assert len(found) == len(rows)
    for r in found:
        want = counts_of(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, r["text"]
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_ratio_equals_brute_force(judged):
    rows, found = judged
    use = rules.Settings()
    raw, good = Counter(), Counter()
    for doc_id, text, _ in rows:
        own = list(grams(text, use))
        raw.update(own)
        if doc_id in (9, 3):
            good.update(own)
    n_raw, n_good = sum(raw.values()) + use.buckets, sum(good.values()) + use.buckets
    for r in found:
        own = list(grams(r["text"], use))
        want = sum(math.log((good[b] + 1) / n_good) - math.log((raw[b] + 1) / n_raw) for b in own) / max(1, len(own))
        assert r["ratio"] == pytest.approx(want, abs=2e-4)
        assert r["kept"] == (not r["base_failed"] and r["ratio"] >= use.threshold)


def test_no_rows_and_no_trusted(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert rules.judge(empty, empty.select("doc_id")).count() == 0
    some = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60)))], "doc_id long, text string")
    assert some.transform(lambda d: rules.judge(d, empty.select("doc_id"))).first()["kept"]


def test_labelled_documents(spark, folder):
    labels = table(spark, folder, "labels")
    found = rules.judge(table(spark, folder, "documents"), labels.filter("quality = 1")).join(labels, "doc_id").filter("NOT base_failed")
    shares = {r["quality"]: r["kept"] for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert shares[1] > 0.97 and shares.get(0, 0) < 0.2
