"""Quality rules: fixed counts, and a log-likelihood ratio of hashed n-grams.

Words and word pairs fall into hash buckets. Two multinomials over the buckets,
one of trusted documents and one of the raw corpus, give every bucket a log
ratio. A document's score is the mean ratio over its n-grams, so length does
not matter, and a fixed threshold decides for every document. Built-in
functions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.bloom import bits_for, build
from granary.llm.common import WORD, let, stage

GAP = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"  # fixed values


@dataclass(frozen=True)
class Settings:
    """``buckets``: size of both multinomials, and so of what travels with the plan; ``smoothing``: added to
    every bucket's count; ``sieve_bits``: most bits of the filter of trusted ids, beyond which more texts are shuffled.
    """

    buckets: int = 1 << 15
    smoothing: float = 1.0
    threshold: float = -0.1
    sieve_bits: int = 1 << 22


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP, -1), "")


def _bucket(hashed: Column, use: Settings) -> Column:
    return F.pmod(hashed, F.lit(use.buckets)).cast("int")


def _rest(items: Column, start: int) -> Column:
    return F.slice(items, start, F.size(items))


def _grams(frame: DataFrame, use: Settings) -> DataFrame:
    """``bucket`` of every word of ``frame(text)``, by its hash, and of the pair that starts there, by both words' hashes.

    The last word's pair has no second hash. Rows instead of lambdas, so that
    hashing and counting are compiled into one stage.
    """
    words = frame.select(words_of(F.col("text")).alias("words"))
    pairs = words.select(F.inline(F.arrays_zip(F.col("words").alias("a"), _rest(F.col("words"), 2).alias("b"))).alias("a", "b"))
    one, two = F.xxhash64("a"), F.when(F.col("b").isNotNull(), F.xxhash64("b"))
    return pairs.select(F.explode(F.array(_bucket(one, use), _bucket(F.xxhash64(one, two), use))).alias("bucket"))


def log_ratios(docs: DataFrame, trusted: DataFrame, use: Settings) -> list[float]:
    """log(trusted / raw) of every bucket, over all of ``docs(doc_id, text)``; ``trusted(doc_id)``. Zero without trusted documents."""
    ids = stage(trusted.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct(), "trusted-ids")
    count = ids.count()
    if not count:
        return [0.0] * use.buckets
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Only texts that pass the filter are shuffled to the join, which makes it exact.
    sieve = build(ids, count, min(use.sieve_bits, bits_for(count, 0.1)))
    chosen = own.filter(sieve.holds(F.col("doc_id"))).join(ids.hint("merge"), "doc_id", "left_semi")

    def by_bucket(frame):
        return _grams(frame, use).groupBy("bucket").count()

    counts = by_bucket(own).withColumnRenamed("count", "raw").join(by_bucket(chosen).withColumnRenamed("count", "good"), "bucket", "left")
    counts = counts.fillna(0, ["good"]).collect()  # one row for each bucket
    raw, good = sum(r["raw"] for r in counts), sum(r["good"] for r in counts)
    if not good:
        return [0.0] * use.buckets
    spread = use.smoothing * use.buckets
    empty = log((raw + spread) / (good + spread))
    ratios = [round(empty, 4)] * use.buckets
    for r in counts:
        ratios[r["bucket"]] = round(log((r["good"] + use.smoothing) / (r["raw"] + use.smoothing)) + empty, 4)
    return ratios


def _repeat_words(windows: Column) -> Column:
    """How many words lie in a three-word window that the text has twice or more, from the hashes of all windows."""

    def covered(placed):
        def spots(p, j):
            same = (F.get(placed, j - 1)["h"] == p["h"], F.get(placed, j + 1)["h"] == p["h"])
            return F.when(F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False)), F.array(p["i"], p["i"] + 1, p["i"] + 2))

        return F.size(F.array_distinct(F.flatten(F.array_compact(F.transform(placed, spots)))))

    def repeated(windows):
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(placed, covered))

    return let(windows, repeated)


def judge(docs: DataFrame, trusted: DataFrame, use: Settings = Settings()) -> DataFrame:
    """Adds the counts, ``ratio`` (the mean log ratio) and ``kept`` to every row; columns of these names are replaced.

    The counts: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``.
    NULL and empty texts have no words: ratio 0, and the base rules reject them.
    """
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "kept")
    table = F.split(F.lit(",".join(map(str, log_ratios(docs, trusted, use)))), ",").cast("array<double>")
    text = F.coalesce(F.col("text"), F.lit(""))

    def by_lines(lines):
        return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")

    def by_hashes(hashes):
        # Every word is hashed once; pairs and windows are made of the numbers.
        return let(F.zip_with(hashes, _rest(hashes, 2), lambda a, b: F.xxhash64(a, b)), lambda pairs: by_pairs(hashes, pairs))

    def by_pairs(hashes, pairs):
        def total(grams):
            return F.aggregate(grams, F.lit(0.0), lambda s, h: s + F.get(table, _bucket(h, use)))

        windows = F.zip_with(F.slice(pairs, 1, F.greatest(F.size(pairs) - 2, F.lit(0))), _rest(hashes, 3), lambda p, c: F.xxhash64(p, c))
        return F.struct(
            _repeat_words(windows).cast("long").alias("n_repeat_words"),
            F.when(F.size(hashes) == 0, 0.0).otherwise((total(hashes) + total(pairs)) / (2 * F.size(hashes))).alias("ratio"),
        )

    words = words_of(text)
    kept = [c for c in docs.columns if c not in added]
    return (
        docs.drop(*added)
        .select(
            *kept,
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
            let(F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD)), by_lines).alias("n_dup_lines"),
            let(F.transform(words, lambda w: F.xxhash64(w)), by_hashes).alias("_counts"),
        )
        .select(*kept, "n_words", "word_chars", "n_symbols", "n_dup_lines", "_counts.n_repeat_words", "_counts.ratio")
        .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= use.threshold))
    )
