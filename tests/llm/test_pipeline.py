import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from granary.llm.common import stage

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))
import corpus_pipeline  # noqa: E402

PASSAGE = " ".join(f"shared{i}" for i in range(60))


@pytest.fixture(scope="module")
def steps(spark, folder):
    """Documents with planted cases, and what every stage makes of them."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    text = docs.filter("doc_id = 2").first()["text"]
    rows = [(10_001, f"{text}\n{PASSAGE}"), (10_002, f"{PASSAGE}\nown words of this text"), (10_003, None), (10_004, ""), (10_004, ""), (None, text[:300])]
    planted = spark.createDataFrame([(i, t, "en", "src1", len(t or "")) for i, t in rows], docs.schema)
    out = [stage(docs.unionByName(planted), "test-docs")]
    for _, function in corpus_pipeline.STAGES:
        out.append(stage(function(spark, out[-1], folder), "test-stage"))
    return out


def test_columns_stay_until_the_last_stage(steps):
    assert all(s.columns == steps[0].columns and s.dtypes == steps[0].dtypes for s in steps[1:-1])


def test_clean_documents_stay_and_junk_goes(spark, folder, steps):
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    kept = {r["quality"]: r["n"] for r in steps[1].join(labels, "doc_id").groupBy("quality").agg(F.countDistinct("doc_id").alias("n")).collect()}
    all_of = {r["quality"]: r["n"] for r in steps[0].join(labels, "doc_id").groupBy("quality").agg(F.countDistinct("doc_id").alias("n")).collect()}
    assert kept[1] >= 0.97 * all_of[1] and kept.get(0, 0) <= 0.3 * all_of[0]


def test_passage_is_left_once(steps):
    texts = [r["text"] for r in steps[2].collect() if r["text"]]
    assert sum(PASSAGE in t for t in texts) <= 1
    assert all(r["n_chars"] == len(r["text"]) for r in steps[2].filter("doc_id in (10001, 10002)").collect())


def test_one_of_each_group_stays(steps):
    from granary.llm import neardup

    ids = [r["doc_id"] for r in steps[3].collect()]
    assert max(n for i, n in Counter(ids).items() if i is not None) == 1
    found = neardup.near_duplicates(steps[2]).filter("doc_id IS NOT NULL").collect()
    assert {r["component_id"] for r in found} == {i for i in ids if i is not None}


def test_mixing_and_packing_lose_nothing(steps):
    assert {r["doc_id"] for r in steps[4].collect()} == {r["doc_id"] for r in steps[3].collect()}
    pieces = steps[5].collect()
    rows = Counter(r["doc_id"] for r in steps[4].collect())
    first = Counter(r["doc_id"] for r in pieces if r["start"] == 0)
    assert first == rows
    filled = Counter()
    for r in pieces:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 2048


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, folder), "test-empty")
    assert docs.count() == 0


def test_only_blank_lines_left_is_nothing_left(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    other = PASSAGE.replace("shared", "other")
    texts = [PASSAGE, other, f"{PASSAGE}\n\n\t\n{other}", f"{PASSAGE}\n\nown"]
    planted = spark.createDataFrame([(i, t, "en", "src1", len(t)) for i, t in enumerate(texts)], docs.schema)
    assert {r["doc_id"] for r in corpus_pipeline.unrepeated_lines(spark, planted, folder).collect()} == {0, 1, 3}


def test_one_id_with_two_different_texts_keeps_both(spark, folder):
    one, two = (" ".join(f"{name}{i}" for i in range(80)) for name in ("alpha", "beta"))
    rows = [(7, one), (7, one + " more"), (7, two), (8, one), (None, two), (None, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.no_near_duplicates(spark, docs, folder)
    assert kept.columns == docs.columns
    texts = [r["text"] for r in kept.collect()]
    assert len(texts) == 4 and sum(t in (one, one + " more") for t in texts) == 1 and texts.count(two) == 1
