"""Which sales the silver fact has to load again, from what arrived in bronze.

Sale headers arrive in date folders; a file stream with a bookmark hands over
the ids of each new file once. Lines come as a full extract each day, so a line
that changed without its sale shows only by comparison: one count and hash per
sale, added up before any join, are held against those of the last load. The
same table keeps the day a sale's lines lie in, so that only touched days of
the fact are read.

A sale that is deleted at the source leaves no trace in either. It is found by
reconciliation with an extract of all sale ids: both sides are dealt into
buckets by hash, with a count and a hash sum of each bucket noted when it was
written; only buckets that differ are compared id by id.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators.members import Ids
from granary.schemas import INT, LONG, struct
from granary.sinks.lake import stage
from granary.sinks.versions import Draft, Version, VersionedTable
from granary.streaming.new_files import append_batches, process_new_files

SALE_KEY = struct(("id", LONG))
DAYS = ("ano", "mes", "dia")
MARKS = ("linhas", "marca_a", "marca_b")
KNOWN, VANISHED = 1, 2
# Per sale: its lines' marks, their day, whether its header is known or has vanished, and its bucket.
STATE = struct(("venda_id", LONG), *[(m, LONG) for m in MARKS], *[(d, INT) for d in DAYS], ("situacao", INT), ("balde", INT))


def bucket(sale: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(sale.cast("long")), F.lit(buckets)).cast("int")


def _halves(value: Column) -> tuple[Column, Column]:
    """Two sums that change with any summand, whatever the order; equal summands do not cancel out."""
    return F.sum(F.shiftright(value, 32)), F.sum(value.bitwiseAND((1 << 32) - 1))


def digests(ids: DataFrame) -> dict[str, list[int]]:
    """Count and hash sums per bucket of ``ids(venda_id, balde)``; one row a bucket reaches the driver."""
    high, low = _halves(F.xxhash64(F.col("venda_id").cast("long")))
    rows = ids.groupBy("balde").agg(F.count("*").alias("n"), high.alias("a"), low.alias("b")).collect()
    return {str(r["balde"]): [r["n"], r["a"], r["b"]] for r in rows}


def key_table(spark: SparkSession, bronze_root: str) -> VersionedTable:
    return VersionedTable(spark, f"{bronze_root}/_keys", "vendas")


def save_keys(spark: SparkSession, bronze_root: str, ids: DataFrame, buckets: int, at: dt.datetime) -> Version:
    """Keep the ids of all sales that the source has now, by bucket, with their digests.

    Take it after the headers of the same day: a sale that is loaded and not
    in a later key extract counts as deleted.
    """
    table = key_table(spark, bronze_root)
    own = ids.select(F.col("id").cast("long").alias("venda_id")).filter("venda_id IS NOT NULL").distinct()
    draft = table.write(own.withColumn("balde", bucket(F.col("venda_id"), buckets)), ["balde"], base=table.current())
    return draft.commit(at, {"digests": digests(draft.read()), "buckets": buckets})


class Arrivals:
    """Noted sale ids, their bookmark, and the per-sale state below one silver folder.

    The fact's versions say up to which batch and with which state they were
    loaded, so nothing is done twice and nothing is forgotten: a run that fails
    before it commits the fact is repeated by the next.
    """

    def __init__(self, spark: SparkSession, silver_root: str, buckets: int, facts: Version | None):
        self.spark, self.buckets = spark, buckets
        self.pending, self.bookmark = f"{silver_root}/_arrivals/sales", f"{silver_root}/_arrivals/bookmark"
        self.table = VersionedTable(spark, f"{silver_root}/_arrivals", "state")
        notes = facts.notes if facts else {}
        self.done, self.keys_done = notes.get("batch", -1), notes.get("keys", 0)
        self.known = self.table.version(notes["state"]) if "state" in notes else None

    def take(self, bronze_sales: str) -> None:
        """Note the ids of every sale in files that no earlier call has seen."""
        stream = self.spark.readStream.schema(SALE_KEY).option("maxFileAge", "36500d").parquet(bronze_sales)
        process_new_files(stream.select(F.col("id").alias("venda_id")), append_batches(self.pending), self.bookmark)

    def waiting(self) -> tuple[DataFrame, int]:
        """Ids noted since the last load, and the number of the newest batch."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.pending)
        kinds = struct(("venda_id", LONG), ("batch_id", LONG))
        if path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            noted = self.spark.read.schema(kinds).parquet(self.pending).filter(F.col("batch_id") > self.done)
        else:
            noted = self.spark.createDataFrame([], kinds)
        newest = noted.agg(F.max("batch_id")).first()[0]
        return noted.select("venda_id").distinct(), self.done if newest is None else newest

    def state(self, parts: set[str] | None = None) -> DataFrame:
        """The state the fact was loaded with, or some of its buckets."""
        if self.known is None:
            return self.spark.createDataFrame([], STATE)
        return self.table.read(self.known, parts)

    def vanished(self, keys: VersionedTable) -> tuple[DataFrame, int]:
        """Known sales that the newest key extract lacks, and that extract's number.

        Digests tell which buckets to compare; no other bucket of either side is
        read. An extract serves once. Buckets dealt otherwise than the state's,
        because their number was changed, are all compared.
        """
        none = self.spark.createDataFrame([], struct(("venda_id", LONG)))
        extract = keys.current()
        if extract is None or self.known is None or extract.number <= self.keys_done:
            return none, self.keys_done
        mine, theirs = self.known.notes.get("digests", {}), extract.notes["digests"]
        if extract.notes["buckets"] != self.known.notes["buckets"]:
            ours, source = self.state(), keys.read(extract)
        else:
            differing = {f"balde={b}" for b in {*mine, *theirs} if mine.get(b) != theirs.get(b)}
            if not differing:
                return none, extract.number
            ours, source = self.state(differing), keys.read(extract, differing)
        known = ours.filter(F.col("situacao") == KNOWN).select("venda_id")
        return known.join(source.select("venda_id"), "venda_id", "left_anti"), extract.number

    def draft(self, state: DataFrame) -> Draft:
        """``state`` lies together by bucket."""
        return self.table.write(state, ["balde"], base=self.table.current(), in_place=True)

    def save(self, state: DataFrame, at: dt.datetime) -> int:
        """Commit the next state with its digests; returns its number, which the fact's version has to name."""
        draft = self.draft(state)
        return draft.commit(at, {"digests": digests(draft.read().filter(F.col("situacao") == KNOWN)), "buckets": self.buckets}).number


def line_marks(lines: DataFrame) -> DataFrame:
    """Per sale: number of lines and a hash that changes with any of them, whatever their order.

    A value is hashed together with its column's name, so a value that moves to
    another column counts as changed, and a new column does as soon as it has
    values.
    """
    named = [F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(c), F.col(c))) for c in sorted(lines.columns)]
    high, low = _halves(F.xxhash64(*named))
    return lines.groupBy(F.col("venda_id").cast("long").alias("venda_id")).agg(F.count("*").alias("linhas"), high.alias("marca_a"), low.alias("marca_b"))


def changed_sales(arrived: DataFrame, marks: DataFrame, state: DataFrame) -> DataFrame:
    """Ids that arrived, or whose lines are not those of the last load."""
    old = state.filter("linhas IS NOT NULL").select("venda_id", *[F.col(m).alias(f"{m}_antes") for m in MARKS])
    same = F.lit(True)
    for m in MARKS:
        same = same & F.col(m).eqNullSafe(F.col(f"{m}_antes"))
    differing = marks.join(old, "venda_id", "full").filter(~same)
    return arrived.union(differing.select("venda_id")).distinct()


def next_state(
    marks: DataFrame, state: DataFrame, changed: DataFrame | Ids, loaded: DataFrame, arrived: DataFrame, vanished: DataFrame, buckets: int
) -> DataFrame:
    """The state of all sales: marks as they are now, days of ``loaded`` for changed sales and as before for others.

    Rows move once, to the task of their bucket, which adds up and may write them.
    ``loaded``: ``venda_id`` and day of the changed sales that the fact holds.
    A sale that arrives is known, even if it had vanished before.
    """
    kinds = {f.name: f.dataType for f in STATE.fields}

    def rows(frame: DataFrame, **values) -> DataFrame:
        """The columns a frame has, NULL for the others."""
        own = {c: F.col(c) for c in frame.columns} | values
        return frame.select(*[own.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in kinds if c != "balde"])

    decided = arrived.union(vanished)
    pieces = [
        rows(marks),
        rows(Ids.of(changed).without(state.filter("ano IS NOT NULL"), "venda_id").select("venda_id", *DAYS)),
        rows(loaded.select("venda_id", *DAYS).distinct()),
        rows(state.filter("situacao IS NOT NULL").select("venda_id", "situacao").join(decided, "venda_id", "left_anti")),
        rows(arrived, situacao=F.lit(KNOWN)),
        rows(vanished.join(arrived, "venda_id", "left_anti"), situacao=F.lit(VANISHED)),
    ]
    together = pieces[0]
    for piece in pieces[1:]:
        together = together.union(piece)
    dealt = together.filter("venda_id IS NOT NULL").withColumn("balde", bucket(F.col("venda_id"), buckets)).repartition("balde")
    merged = dealt.groupBy("balde", "venda_id").agg(*[F.max(c).alias(c) for c in kinds if c not in ("venda_id", "balde")])
    return merged.filter("linhas IS NOT NULL OR situacao IS NOT NULL").select(*kinds)


def days_of(frame: DataFrame) -> list[Mapping]:
    """The distinct days of a frame; bounded by the calendar."""
    return [row.asDict() for row in frame.select(*DAYS).distinct().collect()]


def staged(frame: DataFrame, purpose: str) -> DataFrame:
    return stage(frame, purpose)[0]
