"""The three stages as jobs, and their order."""

from __future__ import annotations

import datetime as dt
import functools
import logging
from collections.abc import Callable, Collection, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.scalars import with_run_metadata
from granary.operators.dedup import latest_by_key
from granary.operators.members import Ids
from granary.plans import gold, incremental, lattice, rules, silver, stored_analyses
from granary.plans.arrivals import VANISHED, Arrivals, changed_sales, days_of, key_table, line_marks, next_state, save_keys, staged
from granary.plans.incremental import FACT_PARTITIONS
from granary.plans.stored_analyses import Dimensions, Limits
from granary.plans.totals import refresh
from granary.schemas import BRONZE, PARTITION_KEYS
from granary.session import configure
from granary.sinks import reports, versions
from granary.sinks.lake import WriteResult, stage, write_bronze
from granary.sinks.versions import VersionedTable
from granary.sources.lake import (
    EXTRACT_KEYS,
    extract_folder,
    read_bronze,
    read_layer_table,
    register_table,
)
from granary.sources.relational import SOURCE_TABLES, SourceTable, changed_on

log = logging.getLogger(__name__)


class TablesFailed(RuntimeError):
    """Some tables failed; the others are loaded. ``errors`` says which and why."""

    def __init__(self, stage: str, errors: dict[str, str], results: list[WriteResult]):
        super().__init__(f"{stage}: " + "; ".join(f"{t}: {e}" for t, e in errors.items()))
        self.errors = errors
        self.results = results


@dataclass(frozen=True)
class Run:
    """Who runs what, when; every job takes these as parameters, none reads a clock."""

    now: dt.datetime
    triggered_by: str = "manual"
    incremental: bool = False

    @property
    def execution_date(self) -> str:
        return self.now.date().isoformat()


@dataclass(frozen=True)
class Lake:
    """Folders of the three layers and the catalog databases that show them."""

    root: str
    silver_database: str = "silver"
    gold_database: str = "gold"
    bronze_database: str = "bronze"
    # Buckets that sale ids are dealt into for reconciliation.
    buckets: int = 64

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"


@dataclass(frozen=True)
class Changes:
    """What a silver run has to load: headers, ids that changed, vanished or arrived, marks and state, and the marks to note."""

    headers: DataFrame
    changed: Ids
    vanished: DataFrame
    arrived: DataFrame
    marks: DataFrame
    state: DataFrame
    newest: int
    keys: int


def _each(stage: str, steps: dict[str, Callable[[], WriteResult]]):
    """Run all steps, whatever fails in between; returns results and errors."""
    results, errors = [], {}
    for table, step in steps.items():
        try:
            results.append(step())
        except Exception as error:
            log.exception("%s of %s failed", stage, table)
            errors[table] = str(error).splitlines()[0] if str(error) else type(error).__name__
    return results, errors


def extract_job(
    spark: SparkSession,
    load: Callable[[SourceTable], DataFrame],
    lake: Lake,
    day: dt.date,
    run: Run,
    tables: Iterable[SourceTable] = SOURCE_TABLES,
) -> DataFrame:
    """Copy each source table's rows of ``day`` to bronze; returns the report.

    ``load`` turns a registry entry into a frame, usually a paged database
    read. The report is saved in any case; the job fails at the end if a table
    failed.
    """
    configure(spark)
    tables = list(tables)

    def extracted(table: SourceTable) -> WriteResult:
        frame = changed_on(load(table), table, day)
        result = write_bronze(frame, lake.bronze, table.name, day=day)
        if result.rows:
            register_table(spark, lake.bronze_database, table.name, result.path, frame.schema, EXTRACT_KEYS, result.folder)
        return result

    steps = {t.name: functools.partial(extracted, t) for t in tables}
    results, errors = _each("extract", steps)
    kinds = {t.name: t.kind for t in tables}
    manifest = reports.manifest(spark, results, day.isoformat(), kinds)
    reports.save_report(manifest, lake.bronze, "_manifest")
    sizes = {row["tabela"]: row["tamanho_mb"] for row in manifest.collect()}
    done = {r.table: r for r in results}
    outcomes = []
    for table in tables:
        result, failure = done.get(table.name), errors.get(table.name)
        wrote = bool(result and result.rows)
        outcomes.append(
            (
                table.name,
                day.isoformat(),
                result.rows if result else 0,
                result.status if result else "error",
                extract_folder(lake.bronze, table.name, day) if wrote else None,
                failure,
                sizes.get(table.name, 0.0),
            )
        )
    report = reports.extract_report(spark, outcomes)
    reports.save_extract_summary(reports.extract_summary(report, "extract", run.now), lake.bronze)
    if errors:
        raise TablesFailed("extract", errors, results)
    return report


def extract_keys_job(spark: SparkSession, load: Callable[[SourceTable], DataFrame], lake: Lake, run: Run) -> None:
    """Copy the ids of all sales that the source has to bronze, for the next silver run to find deleted ones."""
    configure(spark)
    sales = next(t for t in SOURCE_TABLES if t.name == "vendas")
    save_keys(spark, lake.bronze, load(sales).select("id"), lake.buckets, run.now)


def current_rows(
    spark: SparkSession, lake: Lake, table: SourceTable, only: DataFrame | Ids | None = None, key: str = "id"
) -> DataFrame:
    """One row per key of a bronze table.

    Tables extracted in full need their newest folder only, which has each key
    once. The others keep, per key, the row changed last, then the one extracted last. ``only``
    keeps the rows whose ``key`` is one of its ids, before anything is sorted.
    """
    path = f"{lake.bronze}/{table.name}"
    frame = read_bronze(spark, path, BRONZE[table.name], only_latest=not table.incremental)
    if only is not None:
        frame = Ids.of(only).among(frame, key)
    if not table.incremental:
        return frame.drop(*EXTRACT_KEYS)
    order = [c for c in ("atualizado_em", *EXTRACT_KEYS) if c in frame.columns]
    return latest_by_key(frame, [table.key], order).drop(*EXTRACT_KEYS)


def silver_job(
    spark: SparkSession,
    lake: Lake,
    run: Run,
    tables: Iterable[SourceTable] = SOURCE_TABLES,
    only: Collection[str] | None = None,
) -> list[WriteResult]:
    """Bronze to silver: dimensions are replaced, the fact is replaced or extended.

    An incremental run loads the sales that arrived since the last load, in
    whatever date folder, those whose lines changed, and takes out those that
    were deleted at the source; see ``arrivals``. Dimensions are cleaned and
    judged by ``rules``; ``linhas_com_motivos`` lists their rows that break one,
    ``vendas_recusadas`` the lines that the fact leaves out. Each table is written once and
    replaced in one step. If another run has replaced a table meanwhile, this
    one fails for that table, without effect.
    ``only`` limits the run to some silver tables, to repeat those that failed.
    """
    configure(spark)
    entries = {t.name: t for t in tables}

    broken: dict[str, DataFrame] = {}

    @functools.cache
    def bronze(name: str) -> DataFrame:
        """Current rows; of tables with rules cleaned, and without those that a rule refuses."""
        rows = current_rows(spark, lake, entries[name])
        if name not in rules.RULES:
            return rows
        judged, _ = stage(rules.judged(rules.standardised(rows, name), rules.RULES[name]), f"judged-{name}")
        accepted, broken[name] = rules.split(judged)
        return accepted

    def described(frame: DataFrame) -> DataFrame:
        return with_run_metadata(frame, "silver", run.execution_date, run.triggered_by)

    def dimension(name: str, build: Callable[[], DataFrame]) -> WriteResult:
        table = VersionedTable(spark, lake.silver, name)
        return versions.replace(table, described(build()), run.now, PARTITION_KEYS.get(name, ()))

    fact_table = VersionedTable(spark, lake.silver, "facts_vendas")
    base = fact_table.current()
    extend = run.incremental and base is not None
    arrived = Arrivals(spark, lake.silver, lake.buckets, base)

    @functools.cache
    def lines() -> DataFrame:
        return bronze("itens_venda")

    @functools.cache
    def changes() -> Changes:
        arrived.take(f"{lake.bronze}/vendas")
        waiting, newest = arrived.waiting()
        vanished, keys = arrived.vanished(key_table(spark, lake.bronze))
        vanished = staged(vanished.join(waiting, "venda_id", "left_anti"), "vanished-sales")
        marks, state = staged(line_marks(lines()), "line-marks"), arrived.state()
        changed = Ids.of(staged(changed_sales(waiting.union(vanished), marks, state), "changed-sales")) if extend else Ids(waiting, None)
        # Bronze still has the headers of deleted sales.
        deleted = state.filter(F.col("situacao") == VANISHED).select("venda_id").union(vanished).join(waiting, "venda_id", "left_anti")
        headers = current_rows(spark, lake, entries["vendas"], only=changed) if extend else bronze("vendas")
        headers = headers.join(deleted.withColumnRenamed("venda_id", "id"), "id", "left_anti").select(*headers.columns)
        headers = staged(headers, "changed-headers")
        return Changes(headers, changed, vanished, waiting, marks, state, newest, keys)

    def calendar() -> WriteResult:
        if extend:
            known = read_layer_table(spark, lake.silver_database, "dim_tempo")
            return dimension("dim_tempo", lambda: incremental.merge_calendar(known, changes().headers))
        return dimension("dim_tempo", lambda: silver.dim_date(bronze("vendas")))

    totals = {"total_value": "total_venda", "total_items": "quantidade"}

    def measured(of: Callable[[Column], Column]) -> dict[str, Column]:
        return {n: F.sum(of(F.col(c))) for n, c in totals.items()} | {"latest_sale": F.max(of(F.col("data_venda")))}

    def refuse(found: Changes, days: Iterable[Mapping], own_lines: DataFrame) -> None:
        """Keep the lines that the fact leaves out, by the day they would lie in."""
        table = VersionedTable(spark, lake.silver, "vendas_recusadas")
        old, rows = table.current(), described(rules.refused_lines(found.headers, own_lines, lambda some: staged(some, "refused")))
        if extend and old:
            draft, _ = incremental.load_facts(table, old, rows, found.changed, days)
        else:
            draft = table.write(rows, FACT_PARTITIONS, base=old)
        if draft.rows or old and draft.version.folders != old.folders:
            draft.commit(run.now)
            table.publish(lake.silver_database)

    def facts() -> WriteResult:
        found = changes()
        if not extend:
            draft = fact_table.write(described(silver.facts_sales(found.headers, lines())), FACT_PARTITIONS, measured(lambda c: c), base)
            if not draft.rows:
                return draft.result()
            days, own_lines = (), lines()
            rows, loaded = draft.rows, draft.read()
            # Without an earlier state there is nothing to replace in it.
            changed = Ids.of(loaded.select("venda_id")) if arrived.known else Ids(found.state.select("venda_id"), None)
        else:
            if found.changed.frame.isEmpty():
                return WriteResult("facts_vendas", fact_table.root, 0, "skipped")
            own_lines = found.changed.among(lines(), "venda_id")
            batch = described(silver.facts_sales(found.headers, own_lines))
            moment = F.to_date("data_venda")
            new_days = found.headers.select(F.year(moment).alias("ano"), F.month(moment).alias("mes"), F.dayofmonth(moment).alias("dia"))
            old_days = found.changed.among(found.state, "venda_id").select(*FACT_PARTITIONS)
            days = days_of(new_days.union(old_days))
            draft, parts = incremental.load_facts(fact_table, base, batch, found.changed, days, measured(incremental.of_batch))
            rows, changed = draft.metrics["new_rows"], found.changed
            loaded = changed.among(draft.read(parts), "venda_id")
        refuse(found, days, own_lines)
        after = next_state(found.marks, found.state, changed, loaded, found.arrived, found.vanished, lake.buckets)
        state = arrived.save(after, run.now)
        draft.commit(run.now, {"state": state, "batch": found.newest, "keys": found.keys})
        return draft.result(rows)

    steps = {
        "dim_fornecedores": lambda: dimension(
            "dim_fornecedores", lambda: silver.dim_suppliers(bronze("fornecedores"))
        ),
        "dim_categorias": lambda: dimension(
            "dim_categorias", lambda: silver.dim_categories(bronze("categorias"))
        ),
        "dim_produtos": lambda: dimension(
            "dim_produtos",
            lambda: silver.dim_products(
                bronze("produtos"), bronze("categorias"), bronze("fornecedores")
            ),
        ),
        "dim_clientes": lambda: dimension(
            "dim_clientes", lambda: silver.dim_customers(bronze("clientes"), run.now.date())
        ),
        "dim_enderecos": lambda: dimension(
            "dim_enderecos", lambda: silver.dim_addresses(bronze("enderecos"))
        ),
        "dim_tempo": calendar,
        "facts_vendas": facts,
    }
    chosen = {name: step for name, step in steps.items() if only is None or name in only}
    results, errors = _each("silver", chosen)
    if broken:
        lists = [rules.as_report(rows, name) for name, rows in broken.items()]
        _, failed = _each("silver", {"linhas_com_motivos": lambda: save_broken(spark, lake, run, functools.reduce(DataFrame.union, lists), list(broken))})
        errors |= failed
    for result in results:
        table = VersionedTable(spark, lake.silver, result.table)
        if table.current():
            table.publish(lake.silver_database)
    fact = next((r for r in results if r.table == "facts_vendas"), None)
    seen = {**fact.metrics, "total_records": fact.rows} if fact else {}
    report = reports.silver_report(
        spark, run.execution_date, run.triggered_by, run.incremental,
        seen, seen.get("latest_sale"), run.now,
    )
    reports.save_report(report, lake.silver, "_execution_reports")
    if errors:
        raise TablesFailed("silver", errors, results)
    return results


def save_broken(spark: SparkSession, lake: Lake, run: Run, rows: DataFrame, tables: Collection[str]) -> WriteResult:
    """Replace the lists of rows that break a rule, of the tables that this run has judged."""
    target = VersionedTable(spark, lake.silver, "linhas_com_motivos")
    frame = with_run_metadata(rows, "silver", run.execution_date, run.triggered_by)
    result = versions.replace(target, frame, run.now, ["tabela"], replaced=[f"tabela={t}" for t in tables])
    if target.current():
        target.publish(lake.silver_database)
    return result


def gold_job(
    spark: SparkSession, lake: Lake, run: Run, rank_recent_only: bool = False
) -> list[WriteResult]:
    """Silver to gold, from the written silver tables.

    All tables are added up from stored totals; an incremental run brings those
    up to date from the days of the fact that were written since (see
    ``totals``), and replaces only the months of the recent period. Ranked and
    total tables have no months; they cover all days, or with
    ``rank_recent_only`` the recent period too.
    """
    configure(spark)

    def silver_table(name: str) -> DataFrame:
        return read_layer_table(spark, lake.silver_database, name)

    def recent(rows: DataFrame) -> DataFrame:
        return gold.recent_period(rows, run.now.date()) if run.incremental else rows

    facts = VersionedTable(spark, lake.silver, "facts_vendas")
    stored = refresh(spark, lake.gold, facts, run.now, run.incremental)
    ranked = stored.filtered(recent) if rank_recent_only else stored
    goods, kinds = silver_table("dim_produtos"), silver_table("dim_categorias")
    days, _ = stage(stored.per_day(), "day-totals")
    recent_days = recent(days)
    ranked_days = recent_days if rank_recent_only else days
    per_product, _ = stage(ranked.per_product(), "product-totals")

    def save(name: str, table: DataFrame, extra: dict | None = None) -> WriteResult:
        frame = with_run_metadata(table, "gold", run.execution_date, run.triggered_by)
        target, keys = VersionedTable(spark, lake.gold, name), PARTITION_KEYS.get(name, ())
        base, replaced = target.current(), None
        if keys and run.incremental and base:
            # Months of the recent period are replaced, those that lost all their sales too.
            replaced = [p for p in base.folders if _year(p) is not None and _year(p) >= run.now.year - 1]
        return versions.replace(target, frame, run.now, keys, extra, replaced)

    steps = {
        "vendas_mensais": lambda: save("vendas_mensais", gold.monthly_from_days(recent_days)),
        "top_produtos": lambda: save("top_produtos", gold.top_from_products(per_product, goods, kinds)),
        "clientes_vip": lambda: save(
            "clientes_vip", gold.vip_from_customers(ranked.per_customer(), silver_table("dim_clientes"))
        ),
        "performance_categorias": lambda: save(
            "performance_categorias", gold.categories_from_products(per_product, goods, kinds)
        ),
        "vendas_diarias": lambda: save(
            "vendas_diarias", gold.daily_from_days(recent_days, silver_table("dim_tempo"))
        ),
        "resumo_executivo": lambda: save(
            "resumo_executivo",
            gold.summary_from_days(ranked_days, run.execution_date),
            {"facts": F.max("total_transacoes")},
        ),
    }
    results, errors = _each("gold", steps)
    for result in results:
        table = VersionedTable(spark, lake.gold, result.table)
        if table.current():
            table.publish(lake.gold_database)
    summary = next((r for r in results if r.table == "resumo_executivo"), None)
    report = reports.gold_report(
        spark, run.execution_date, run.triggered_by, run.incremental,
        sum(r.rows for r in results), (summary.metrics.get("facts") or 0) if summary else 0, run.now,
    )
    reports.save_report(report, lake.gold, "_gold_execution_reports")
    if errors:
        raise TablesFailed("gold", errors, results)
    return results


def analyses_job(spark: SparkSession, lake: Lake, run: Run, limits: Limits = Limits()) -> list[WriteResult]:
    """Store the analyses of sales, customers, products and regions as gold tables.

    All are added up from the stored totals of ``lattice``, so the fact is read
    once for each of its four tables, however many analyses there are; an
    incremental run reads the days only that were written since. Each analysis
    covers all days and is replaced whole, in one step.
    """
    configure(spark)

    def silver_table(name: str) -> DataFrame:
        return read_layer_table(spark, lake.silver_database, name)

    goods = silver_table("dim_produtos")
    dimensions = Dimensions(goods, silver_table("dim_clientes"), silver_table("dim_enderecos"), silver_table("dim_tempo"))
    stored = lattice.refresh(spark, lake.gold, VersionedTable(spark, lake.silver, "facts_vendas"), goods, run.now, run.incremental)

    def save(name: str, build: Callable[[], DataFrame]) -> WriteResult:
        table = VersionedTable(spark, lake.gold, name)
        result = versions.replace(table, with_run_metadata(build(), "gold", run.execution_date, run.triggered_by), run.now)
        if table.current():
            table.publish(lake.gold_database)
        return result

    builders = stored_analyses.tables(stored, dimensions, run.now.date(), limits)
    results, errors = _each("analyses", {name: functools.partial(save, name, build) for name, build in builders.items()})
    if errors:
        raise TablesFailed("analyses", errors, results)
    return results


def _year(part: str) -> int | None:
    value = part.split("/")[0].removeprefix("ano=")
    return int(value) if value.lstrip("-").isdigit() else None


def run_layers(spark: SparkSession, lake: Lake, run: Run) -> list[WriteResult]:
    """Silver, then gold; gold does not start when a silver table failed."""
    return silver_job(spark, lake, run) + gold_job(spark, lake, run)
