"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into bins. Cyclic boosting visits the features in turn
and adds a shallow tree of one feature, times a small rate, to that feature's
lookup table; then it does the same with the feature pairs that explain most of
what is left. A score is a sum of table entries, found by bin numbers. Only the
fit uses labels, on a bounded sample; features come from the text alone.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import crc_remainder, stage

FEATURES = (
    "log_words", "word_length", "signs", "upper", "digits", "stops", "bangs", "bars", "beyond_ascii",
    "distinct_words", "distinct_pairs", "distinct_lines", "line_words", "ends_in_stop", "most_common",
)  # fixed values
UPPER, DIGITS, SIGNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>{}[]@^~_=\\/"
ASCII = bytes(range(128))


@dataclass(frozen=True)
class Settings:
    """``sample``: most labelled rows that the fit may see, the first by hash of their id."""

    sample: int = 20_000
    bins: int = 32
    rounds: int = 200
    pair_rounds: int = 60
    pairs: int = 5
    pair_bins: int = 16
    rate: float = 0.1
    leaves: int = 3
    ridge: float = 1.0


def text_features(text: bytes | None) -> list[float]:
    """Shares and counts of one whole text; an empty text has zeros."""
    text = text or b""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    size, count = len(text), len(words)
    lacks = lambda signs: (size - len(text.translate(None, signs))) / size
    lines = [x for x in text.split(b"\n") if x.strip()]
    often = Counter(words)
    pairs = set(zip(words, words[1:]))
    return [
        float(np.log(count)),
        sum(map(len, words)) / count,
        lacks(SIGNS),
        lacks(UPPER),
        lacks(DIGITS),
        lacks(b".,;:"),
        lacks(b"!?"),
        lacks(b"|"),
        1 - lacks(ASCII),
        len(often) / count,
        len(pairs) / max(1, count - 1),
        len(set(lines)) / len(lines),
        count / len(lines),
        sum(x.rstrip().endswith((b".", b"!", b"?", b":")) for x in lines) / len(lines),
        max(often.values()) / count,
    ]


def features(docs: DataFrame) -> DataFrame:
    """``doc_id, features`` for every row of ``docs(doc_id, text, ...)``."""
    width = len(FEATURES)

    def run(batches):
        for batch in batches:
            values = [v for t in batch.column(1).cast(pa.binary()).to_pylist() for v in text_features(t)]
            offsets = np.arange(0, len(values) + 1, width, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(values, pa.float64()))], ["doc_id", "features"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, features array<double>")


@dataclass
class Model:
    """``tables[f]``: one value for each bin of feature f; ``pair_tables``: (f, g, values by bin pair)."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], "right")]
        if self.pair_tables:
            coarse = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.pair_edges)]
            for f, g, table in self.pair_tables:
                total += table[coarse[f], coarse[g]]
        return 1 / (1 + np.exp(-total))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Newton steps of a shallow regression tree over ordered bins: the best cuts, one after the other."""
    g, h = np.append(0, np.cumsum(gradient)), np.append(0, np.cumsum(weight))
    part = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)
    cuts = [0, len(gradient)]
    while len(cuts) <= leaves:
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:]):
            inner = np.arange(a + 1, b)
            if len(inner):
                gain = part(a, inner) + part(inner, b) - part(a, b)
                best = max(best, (float(gain.max()), int(inner[gain.argmax()])), key=lambda x: x[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    steps = np.zeros(len(gradient))
    for a, b in zip(cuts, cuts[1:]):
        steps[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
    return steps


def _pair_tree(gradient: np.ndarray, weight: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and Newton steps of a tree with one cut of the first feature and one of the second in each half."""
    n, m = gradient.shape
    best = (-1.0, np.zeros((n, m)))
    for cut in range(1, max(n, 2)):
        steps, gain = np.zeros((n, m)), 0.0
        for rows in (slice(0, cut), slice(cut, n)):
            g, h = gradient[rows].sum(0), weight[rows].sum(0)
            step = _tree(g, h, 2, ridge)
            gain += float((step * g - step**2 * (h + ridge / max(1, m)) / 2).sum())
            steps[rows] = step
        if gain > best[0]:
            best = (gain, steps)
    return best


def fit(x: np.ndarray, y: np.ndarray, use: Settings = Settings()) -> Model:
    """Model of labels 0 and 1 over rows of features. Without both labels, the smoothed share is the score of every row."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(float(np.log(share / (1 - share))), [_edges(c, use.bins) if len(y) else np.empty(0) for c in x.T], [])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if len(np.unique(y)) < 2:
        return model
    bins = [np.searchsorted(e, c, "right") for e, c in zip(model.edges, x.T)]
    total = np.full(len(y), model.base)

    def residual():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(use.rounds):
        for f, b in enumerate(bins):
            g, h = residual()
            size = len(model.tables[f])
            step = use.rate * _tree(np.bincount(b, g, size), np.bincount(b, h, size), use.leaves, use.ridge)
            model.tables[f] += step
            total += step[b]

    model.pair_edges = [_edges(c, use.pair_bins) for c in x.T]
    coarse = [np.searchsorted(e, c, "right") for e, c in zip(model.pair_edges, x.T)]
    sizes = [len(e) + 1 for e in model.pair_edges]

    def grid(f, g, values):
        return np.bincount(coarse[f] * sizes[g] + coarse[g], values, sizes[f] * sizes[g]).reshape(sizes[f], sizes[g])

    g, h = residual()
    gains = [(_pair_tree(grid(a, b, g), grid(a, b, h), use.ridge)[0], a, b) for a in range(len(sizes)) for b in range(a)]
    chosen = [(a, b) for _, a, b in sorted(gains, key=lambda v: (-v[0], v[1], v[2]))[: use.pairs]]
    tables = {p: np.zeros((sizes[p[0]], sizes[p[1]])) for p in chosen}
    for _ in range(use.pair_rounds):
        for a, b in chosen:
            g, h = residual()
            step = use.rate * _pair_tree(grid(a, b, g), grid(a, b, h), use.ridge)[1]
            tables[a, b] += step
            total += step[coarse[a], coarse[b]]
    model.pair_tables = [(a, b, t) for (a, b), t in tables.items()]
    return model


def learn(known: DataFrame, labels: DataFrame, use: Settings) -> Model:
    """Model from ``known(doc_id, features)`` and ``labels(doc_id, quality)``, on at most ``sample`` rows."""
    label = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna().groupBy("doc_id").agg(F.min("quality").alias("quality"))
    learnt = known.select("doc_id", "features").join(label, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(use.sample)
    rows = learnt.select("features", "quality").toPandas()
    return fit(np.array(rows["features"].tolist(), float).reshape(-1, len(FEATURES)), rows["quality"].to_numpy(float), use)


def score(docs: DataFrame, labels: DataFrame, use: Settings = Settings(), folds: int = 3, held: int = 1) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text, ...)``.

    ``labels(doc_id, quality)``: rows whose id's crc32 modulo ``folds`` is
    ``held`` are never learnt from, nor are NULL labels and ids; an id with
    several labels counts with the lowest. Texts are read once; features are a
    written table. Repeated rows get a score each.
    """
    known = stage(features(docs), "quality-features").withColumn("held_out", crc_remainder(F.col("doc_id"), folds) == held)
    model = learn(known.filter(~F.col("held_out")), labels, use)

    def run(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(model.score(x), pa.float64())], ["doc_id", "held_out", "score"])

    scored = known.select("doc_id", "features", "held_out").mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, use: Settings = Settings(), folds: int = 3, held: int = 1) -> DataFrame:
    """The rows of ``docs`` that score 0.5 or more, with all their columns; learnt as in ``score``.

    Texts are read twice, to learn and to judge, but never shuffled.
    """
    known = features(docs.filter(crc_remainder(F.col("doc_id"), folds) != held).join(F.broadcast(_sample_ids(labels, use)), "doc_id", "left_semi"))
    model = learn(known, labels, use)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            x = np.array([text_features(t) for t in batch.column(at).cast(pa.binary()).to_pylist()], float).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(model.score(x) >= 0.5, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _sample_ids(labels: DataFrame, use: Settings) -> DataFrame:
    """Twice as many labelled ids as the sample may hold, so that a fold can go; a bounded table."""
    return labels.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * use.sample)
