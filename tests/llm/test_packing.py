import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from granary.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.integers(1, 512), max_size=60), st.integers(512, 700))
@settings(max_examples=60, deadline=None)
def test_windows_never_exceed_the_capacity(sizes, capacity):
    sizes = np.array(sizes, np.int64)
    window = packing.windows_of(sizes, capacity)
    assert len(window) == len(sizes)
    assert not len(sizes) or np.bincount(window, sizes).max() <= capacity


def test_differencing_is_near_equal():
    sizes = np.random.default_rng(3).integers(1, 512, 400)
    sums = np.bincount(packing.differencing(sizes, 50), sizes, 50)
    assert sums.sum() == sizes.sum() and sums.max() - sums.min() < 0.02 * sums.mean()


def numbers(ids):
    return np.frombuffer(ids, "<u4").tolist()


def test_words_put_together_equal_the_whole_text():
    tokenizer, ids_of = Tokenizer.from_file(PATH), packing.WordIds(PATH, limit=30)
    texts = ["", "  a\n\nB c\t d\x0be", "İstanbul ΑΣ Σ é é <|endoftext|> x<|startoftext|>y", "don't 12345 ###!! ñandú zwei drei \x1c \x85 end", "漢字 かな 🙂🙂 á ́b", "w " * 50]
    texts += [" ".join(f"word{i}x" for i in range(100))] * 2
    texts += ["It's (A) \"quoted\" - x--y THE!! the### ÜBER, Ångström. \u212b\u212a H\u0331. I\u0307x, a'll.' o'd, end'"]
    for text, ids in zip(texts, ids_of(texts)):
        assert numbers(ids) == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_ids_of_all_documents(spark, folder):
    tokenizer, ids_of = Tokenizer.from_file(PATH), packing.WordIds(PATH, 1_000_000)
    texts = [r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [numbers(ids) for ids in ids_of(texts)] == want


def test_every_id_lies_in_one_piece(spark):
    long = " ".join(f"token{i}" for i in range(4000))
    texts = [long, None, "", "Hello, World", long, "x " * 2047, "a b c"] + [f"text number {i} " * (i % 40) for i in range(300)]
    frame = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)] + [(3, "Hello, World", 5), (None, "no id", 5)], "doc_id long, text string, sequence_id int")
    use = packing.Settings(PATH, pool=64)
    rows = packing.pack(frame, use).collect()
    tokenizer = Tokenizer.from_file(PATH)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for doc_id, text in enumerate(texts):
        if doc_id == 3:
            continue  # repeated
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        own = sorted(by_doc[doc_id], key=lambda r: r["start"])
        assert b"".join(r["ids"] for r in own) == struct.pack(f"<{len(want)}I", *want)
        assert [r["start"] for r in own] == list(np.cumsum([0] + [r["length"] for r in own])[:-1])
        assert {r["doc_tokens"] for r in own} == {len(want)}
    assert len(by_doc[3]) == 2 and len(by_doc[None]) == 1
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == list(np.cumsum([0] + [r["length"] for r in own])[:-1])
        assert sum(r["length"] for r in own) <= 2048


def test_no_documents(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), packing.Settings(PATH)).count() == 0


@pytest.mark.parametrize("total", [1, 511, 512, 2048, 2049, 5000])
def test_cuts_cover(total):
    own = packing.cuts(total, 2048, 512)
    assert sum(n for _, n in own) == total and [s for s, _ in own] == list(np.cumsum([0] + [n for _, n in own])[:-1])


def test_odd_letters_marks_and_signs_equal_the_tokenizer():
    rng = random.Random(1)
    signs = list("abzABZ09") + ["İ", "Σ", "ς", "K", "Å", "é", "é", "̇", "̱", "ﬁ", "Ǆ", "ß", "ŉ", "漢", "²", "‍", "ͅ", "ΐ", "-", "'", ".", ",", "!", "#", '"', "(", "/", "=", " ", "\n", " ", "👍"]
    texts = ["İ-", "İ.", "aİ)", "İİ!!"] + ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 9))) for _ in range(20_000)]
    tokenizer, ids_of = Tokenizer.from_file(PATH), packing.WordIds(PATH, limit=3000)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    found = [ids for low in range(0, len(texts), 500) for ids in ids_of(texts[low : low + 500])]
    assert [t for t, ids, w in zip(texts, found, want) if numbers(ids) != w] == []
