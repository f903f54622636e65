"""Merkle manifest of a dataset, its nodes labelled with nested intervals.

Every row is a leaf. Leaves of one group (a language) are ranked by their order,
and a node carries the interval of leaf ranks that it covers: a leaf ``[r, r +
1)``, its parent the eight of them, and so on until one node is left, the
group's subroot. Subroots are leaves of a second tree, whose only node at the
top is the root.

Nothing follows pointers. A node meets its parent by a join on the parent's
bucket (the rank divided by the parent's width) and containment of intervals;
its siblings are the parent's interval without its own, those that end where it
begins or earlier on its left, the others on its right. What a leaf needs to
get to the root, the digests left and right of it on each level, is handed down
from the top once per node, so leaves receive it once per family of eight.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import LOWER, UPPER, crc_remainder, ranked, stage

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RESULT = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
STEPS = "array<struct<before: string, after: string>>"


def field(value: Column) -> Column:
    """A value as it enters a digest: ``-`` for NULL, else its UTF-8 length, a colon, and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*texts: Column) -> Column:
    """Lowercase hex SHA-256 of texts put together."""
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda c: c["digest"]), "")


@dataclass(frozen=True)
class Tree:
    """``families``: the leaves of each lowest node, in order; ``levels``: the nodes of each level from the lowest, with their children."""

    families: DataFrame
    levels: list[DataFrame]

    @property
    def tops(self) -> DataFrame:
        """``g, digest``: the one node of each group that covers all its leaves."""
        parts = [level.filter("lo = 0 AND hi = n").select("g", "digest") for level in self.levels]
        top = parts[0]
        for part in parts[1:]:
            top = top.union(part)
        return top


def tree(leaves: DataFrame, carried: list[str], purpose: str) -> Tree:
    """Digests of all nodes above ``leaves(g, rank, n, digest, ...)``; each leaf keeps its ``carried`` columns.

    Each level is grouped by (group, bucket), at most eight nodes to a key,
    however many leaves a group has, and written, since both the next level and
    the way down read it.
    """
    own = F.struct(F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", *carried)
    nodes = stage(_parents(leaves.withColumn("lo", F.col("rank")), own, FANOUT), f"{purpose}-1")
    families = nodes
    levels = [nodes]
    width = FANOUT
    while not nodes.filter(F.col("n") > width).isEmpty():
        width *= FANOUT
        below = nodes.filter(F.col("n") > width // FANOUT)
        nodes = stage(_parents(below, F.struct("lo", "hi", "digest"), width), f"{purpose}-{len(levels) + 1}")
        levels.append(nodes)
    return Tree(families, levels)


def _parents(nodes: DataFrame, child: Column, width: int) -> DataFrame:
    grouped = nodes.groupBy("g", _bucket("lo", width).alias("bucket")).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(child)).alias("children"))
    many = digest(_joined(F.col("children")))
    return grouped.select(
        "g", "n",
        F.get("children", F.lit(0))["lo"].alias("lo"),
        F.element_at("children", -1)["hi"].alias("hi"),
        # A group's only leaf is its subroot, without another digest on top.
        F.when(F.col("n") == 1, F.get("children", F.lit(0))["digest"]).otherwise(many).alias("digest"),
        "children",
    )


def _bucket(rank: str, width: int) -> Column:
    return F.expr(f"{rank} div {width}L")


def _step(lo: Column, hi: Column, n: Column, children: Column) -> Column:
    """The level's siblings of the node [lo, hi), as one step of a path; none where the node is all there is."""
    left = F.filter(children, lambda c: c["hi"] <= lo)
    right = F.filter(children, lambda c: c["lo"] >= hi)
    step = F.array(F.struct(_joined(left).alias("before"), _joined(right).alias("after")))
    return F.when(n > 1, step).otherwise(F.expr(f"cast(array() AS {STEPS})"))


def paths(built: Tree, tops: DataFrame) -> DataFrame:
    """The lowest nodes, each with the steps from itself upwards, and what ``tops(g, path, ...)`` says of its group."""
    extra = [c for c in tops.columns if c not in ("g", "path")]
    above = None
    for number in range(len(built.levels), 0, -1):
        nodes = built.levels[number - 1]
        topmost = nodes.filter("lo = 0 AND hi = n").join(tops, "g").select("g", "n", "lo", "hi", "children", "path", *extra)
        if above is not None:
            width = FANOUT ** (number + 1)
            parent = above.select(
                F.col("g").alias("pg"), F.col("lo").alias("plo"), F.col("hi").alias("phi"), F.col("children").alias("siblings"), F.col("path").alias("up"), *extra
            ).withColumn("pb", _bucket("plo", width))
            inner = nodes.filter("NOT (lo = 0 AND hi = n)").withColumn("b", _bucket("lo", width))
            contained = (F.col("g") == F.col("pg")) & (F.col("b") == F.col("pb")) & (F.col("plo") <= F.col("lo")) & (F.col("hi") <= F.col("phi"))
            path = F.concat(_step(F.col("lo"), F.col("hi"), F.col("n"), F.col("siblings")), F.col("up"))
            below = inner.join(parent, contained).select("g", "n", "lo", "hi", "children", path.alias("path"), *extra)
            topmost = topmost.union(below)
        above = topmost
    return above


def _leaves(built: Tree, tops: DataFrame) -> DataFrame:
    """One row per leaf: its own columns, its path to the root, and what ``tops`` says."""
    low = paths(built, tops)
    extra = [c for c in tops.columns if c not in ("g", "path")]
    each = low.select("g", "n", "children", F.col("path").alias("up"), *extra, F.explode("children").alias("leaf"))
    step = _step(F.col("leaf.lo"), F.col("leaf.hi"), F.col("n"), F.col("children"))
    return each.select("g", "leaf", F.concat(step, "up").alias("path"), *extra)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf digest and the siblings on its path give."""
    return F.aggregate(path, start, lambda d, s: digest(s["before"], d, s["after"]))


def proof(path: Column) -> Column:
    """One digest of all siblings of a path, lowest level first, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def audited(leaves: DataFrame) -> DataFrame:
    """``leaves(g, order, digest, claimed, ...)`` with ``leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``g``: group, ``order``: place in the group, ``digest``: the leaf as it
    belongs into the manifest, ``claimed``: the digest that is offered now (NULL:
    the same); it is folded up with the manifest's siblings and verified if
    that gives the root. Other columns are kept, except those that bear a name
    of the result.
    NULL orders come first; rows of equal order go by digest, and rows equal in
    both are interchangeable. No leaves give no rows.
    """
    carried = [c for c in leaves.columns if c not in ("g", "order", "digest", *RESULT)]
    leaves = leaves.select("g", "order", "digest", *carried)
    staged = stage(leaves.withColumn("_row", F.monotonically_increasing_id()), "manifest-leaves")
    placed = ranked(staged, "g", ["order", "digest", "_row"], "manifest-ranked").drop("_row", "order")
    groups = tree(placed, carried, "manifest-group")
    subroots = groups.tops.select(F.lit(0).alias("g"), F.col("g").alias("order"), "digest")
    second = tree(ranked(subroots, "g", ["order"], "manifest-subroots").withColumnRenamed("order", "group"), ["group"], "manifest-top")
    root = second.tops.select("g", F.col("digest").alias("root"), F.expr(f"cast(array() AS {STEPS})").alias("path"))
    tops = _leaves(second, root).select(F.col("leaf.group").alias("g"), F.col("leaf.digest").alias("subroot"), "root", "path")
    every = _leaves(groups, stage(tops, "manifest-tops"))
    offered = F.coalesce(F.col("leaf.claimed"), F.col("leaf.digest"))
    every = every.withColumn("folded_root", folded(offered, F.col("path")))
    return every.select(
        *[F.col(f"leaf.{c}").alias(c) for c in carried if c != "claimed"],
        F.col("leaf.digest").alias("leaf"), "subroot", "root",
        proof(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def audit_documents(docs: DataFrame, claimed_text: Column | None = None) -> DataFrame:
    """``doc_id`` and the columns of :func:`audited` for every row of ``docs``.

    Leaves are digests of the five ``FIELDS``, groups are languages (NULL first,
    then by UTF-8 bytes), the order is ``doc_id``. ``claimed_text``: the text
    offered now; where it is NULL, the row is offered as it stands. Columns
    beyond the five play no part. Texts are hashed whole, whatever their
    length; a NULL field is not the same as an empty one.
    """
    own = {c: F.col(c) for c in FIELDS}
    leaf = digest(*[field(c) for c in own.values()])
    changed = F.lit(None).cast("string")
    if claimed_text is not None:
        changed = F.when(claimed_text.isNotNull(), digest(*[field(c) for c in (own | {"text": claimed_text}).values()]))
    group = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-"))
    leaves = docs.select(group.alias("g"), F.col("doc_id").alias("order"), leaf.alias("digest"), "doc_id", changed.alias("claimed"))
    return audited(leaves)


def tampered_text() -> Column:
    """Texts of rows whose id's crc32 is divisible by 3, in lower case (A-Z only); NULL elsewhere."""
    return F.when(crc_remainder(F.col("doc_id"), 3) == 0, F.translate("text", UPPER, LOWER))
