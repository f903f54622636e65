"""URL filters: a Bloom filter cascade gives exact membership without joins.

Every url has candidate keys: each suffix of its host, cut at dots, followed by
a start of its path. The universe is all candidate keys of the corpus. Level 0
of a cascade encodes the listed keys, level 1 the keys of the universe that
level 0 takes for listed by mistake, level 2 the listed keys that level 1 takes
for mistakes, and so on until a level makes none. A key's answer is then exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.bloom import Bloom, bits_for, build
from granary.llm.common import LOWER, UPPER, stage

# (host, path, verdict): fixed values.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
DEFAULT_VERDICT = "allow"
PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"
# A cascade travels with the plan. Its size follows the list of rules, not the
# corpus; a list whose first level needs more than 8 MB is refused.
MAX_BITS = 1 << 26


def _level(keys: DataFrame, count: int, error: float, number: int) -> Bloom:
    bits = bits_for(count, error)
    if bits > MAX_BITS:
        raise ValueError(f"{count} listed keys need {bits} bits, more than {MAX_BITS}: split the list of rules")
    return build(keys.select("key"), count, bits, 1000 * number)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Bloom, ...]

    def lists(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        if not self.levels:
            return F.lit(False)
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            answer = F.when(~self.levels[i].holds(key), F.lit(i % 2 == 1)).otherwise(answer)
        return answer


def build_cascade(universe: DataFrame, listed: str) -> Cascade:
    """``universe``: distinct ``key`` with a boolean column ``listed``; it is read for level 0 only.

    Level 0 errs so seldom that its mistakes are about as many as the listed
    keys; each later level halves what is left. Bits in all: about
    listed * (1.44 * log2(universe / listed) + 3).
    """
    counts = universe.agg(F.count_if(F.col(listed)).alias("inside"), F.count_if(~F.col(listed)).alias("outside")).first()
    inside, outside = counts["inside"], counts["outside"]
    if not inside:
        return Cascade(())
    levels = [_level(universe.filter(listed), inside, min(0.5, inside / (math.sqrt(2) * max(outside, 1))), 0)]
    keys = stage(universe.filter(F.col(listed) | levels[0].holds(F.col("key"))).select("key", listed), "url-keys")
    sets = [keys.filter(~F.col(listed)), keys.filter(listed)]  # what the next level holds, what it must not hold
    while left := sets[0].count():
        level = _level(sets[0], left, 0.5, len(levels))
        levels.append(level)
        sets = [sets[1].filter(level.holds(F.col("key"))), sets[0]]
    return Cascade(tuple(levels))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for NULL and without ``://``."""
    part = lambda i: F.coalesce(F.regexp_extract(url, PARTS, i), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def candidate_keys(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """Host suffixes of at most ``labels`` labels, each with the path's starts of the given lengths."""
    parts = F.split(host, "\\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))), lambda n: F.array_join(F.slice(parts, -n, n), "."))
    return F.flatten(
        F.transform(
            F.filter(suffixes, lambda s: s != ""),
            lambda s: F.array_compact(F.array(*[F.when(F.length(path) >= n, F.concat(s, F.substring(path, 1, n))) for n in lengths])),
        )
    )


def rule_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host, path, rule, verdict`` to every row; columns of these names are replaced.

    A rule fits its host and all subdomains if the path starts with the rule's
    path; the longest fitting rule decides, a block rule before an allow rule
    of the same key. Without one, ``rule`` is NULL and the verdict is allow.
    """
    shape = rules.agg(F.max(F.size(F.split("host", "\\.", -1))).alias("labels"), F.array_sort(F.collect_set(F.length("path"))).alias("lengths")).first()
    host, path = url_parts(F.col(url))
    keys = candidate_keys(F.col("host"), F.col("path"), shape["labels"] or 1, shape["lengths"])
    judged = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path}).withColumn("_keys", keys)
    listed = rules.groupBy(F.concat("host", "path").alias("key")).agg(F.bool_or(F.col("verdict") == "block").alias("blocks"))
    seen = judged.select(F.explode("_keys").alias("key")).distinct()
    universe = stage(seen.join(listed, "key", "left").select("key", F.coalesce("blocks", F.lit(False)).alias("block"), F.coalesce(~F.col("blocks"), F.lit(False)).alias("allow")), "url-universe")
    block, allow = build_cascade(universe, "block"), build_cascade(universe, "allow")
    fitting = F.filter("_keys", lambda k: block.lists(k) | allow.lists(k))
    longest = F.array_max(F.transform(fitting, lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))))["key"]
    return (
        judged.withColumn("rule", longest)
        .withColumn("verdict", F.when(F.col("rule").isNull(), DEFAULT_VERDICT).when(block.lists(F.col("rule")), "block").otherwise("allow"))
        .drop("_keys")
    )
