"""Stored totals from which the gold tables are added up.

Two tables hold sums, counts and limits that can be merged: one row per day and
product, one per day and customer, in the partitions of the fact. Each notes the
version of the fact it was built from. A later run compares the folders of that
version with those of the newest, reads only days that were written since, and
replaces only theirs; days that are gone from the fact go from the totals.
Whatever a gold table needs beyond that is a sum over stored rows.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.plans import gold
from granary.schemas import PARTITION_KEYS, SILVER
from granary.sinks.lake import rebalanced
from granary.sinks.versions import Draft, Version, VersionedTable, changed_parts

DAY = ("dim_tempo_data", *PARTITION_KEYS["facts_vendas"])


def product_days(facts: DataFrame) -> DataFrame:
    return facts.groupBy(*DAY, F.col("dim_produto_id").alias("produto_id")).agg(*gold.measures("total_venda", "preco_unitario"), *gold.span())


def customer_days(facts: DataFrame) -> DataFrame:
    return facts.groupBy(*DAY, F.col("dim_cliente_id").alias("cliente_id")).agg(*gold.measures("total_venda"), *gold.span())


@dataclass(frozen=True)
class Totals:
    """Both tables at one version of the fact."""

    products: DataFrame
    customers: DataFrame

    def filtered(self, keep: Callable[[DataFrame], DataFrame]) -> Totals:
        return Totals(keep(self.products), keep(self.customers))

    def per_day(self) -> DataFrame:
        """As :func:`gold.day_totals`. A line has one product, so products add up to days."""
        return gold.added_up(self.products, "dim_tempo_data", "ano", "mes")

    def per_product(self) -> DataFrame:
        return gold.added_up(self.products, "produto_id")

    def per_customer(self) -> DataFrame:
        return gold.added_up(self.customers, "cliente_id")


def by_partition(build: Callable[[DataFrame], DataFrame], facts: VersionedTable, version: Version, parts: Collection[str] | None = None) -> DataFrame:
    """What ``build`` makes of some partitions, the rows of each together.

    A task that reads whole partitions sees all rows that can share a group, so
    nothing is shuffled. Only partitions too large for one task are.
    """
    small, large = facts.read_whole(version, parts)
    built = [build(frame) for frame in small]
    if large is not None:
        built.append(rebalanced(build(large), version.partition_by))
    return functools.reduce(DataFrame.union, built)


def bring_up(
    spark: SparkSession,
    root: str,
    facts: VersionedTable,
    at: dt.datetime,
    incremental: bool,
    name: str,
    build: Callable[[DataFrame], DataFrame],
    depends: str | None = None,
    in_place: bool = True,
) -> DataFrame:
    """One stored table, brought up to the fact's newest version.

    ``build`` reduces the fact, or some of its partitions, to rows that keep the
    partitions apart. ``depends`` stands for whatever else ``build`` reads; if
    it is not what it was, or new columns of the fact give the table new columns,
    all partitions are built again. ``in_place``: ``build`` leaves a partition's
    rows where they were read, but for groups that name the partition.
    """
    table = VersionedTable(spark, root, name)
    base, version = table.current(), facts.current()
    if version is None:
        return build(spark.createDataFrame([], SILVER["facts_vendas"]))
    seen = facts.version(base.notes["facts"]) if base else None
    notes = {"facts": version.number, "depends": depends}
    columns = set(build(spark.createDataFrame([], version.schema)).columns)
    same = base is not None and (base.partition_by, base.notes.get("depends")) == (version.partition_by, depends) and columns <= set(base.schema.names)

    def written_again(base: Version | None, parts: Collection[str] | None = None, replaced: Collection[str] | None = None) -> Draft:
        rows = by_partition(build, facts, version, parts) if in_place else build(facts.read(version, parts))
        return table.write(rows, version.partition_by, base=base, replaced=replaced, in_place=in_place)

    if incremental and seen and same:
        written, gone = changed_parts(seen, version)
        if not written and not gone:
            return table.read(base)
        draft = written_again(base, written, written | gone)
    else:
        draft = written_again(base)
    return table.read(draft.commit(at, notes))


def refresh(spark: SparkSession, gold_root: str, facts: VersionedTable, at: dt.datetime, incremental: bool) -> Totals:
    """Bring both tables up to the fact's newest version and return them."""
    bring = functools.partial(bring_up, spark, f"{gold_root}/_totals", facts, at, incremental)
    return Totals(bring("products", product_days), bring("customers", customer_days))
