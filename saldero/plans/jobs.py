"""Incremental jobs: load days, curate days, rebuild months, run one day.

A job stages the rows it is about to write, judges the staged rows and then
publishes them, so that what was judged is what is written. When a day fails
its rules, the days before it are published, the failing day and later ones are
not, and the error names the rules.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import day_range, month_label, replay_day
from ..operators.enrich import (
    COST_TYPES,
    add_costs,
    monthly_base,
    monthly_expenses,
    monthly_targets,
    with_position,
)
from ..operators.fingerprint import SUMS, fingerprints
from ..operators.quality import (
    Limits,
    RulesBroken,
    curated_report,
    monthly_report,
    raw_report,
)
from ..session import scratch
from ..sources.lake import (
    CURATED_EXPENSES,
    CURATED_SALES,
    CURATED_TARGETS,
    DAY_PARTITION,
    MONTH_PARTITION,
    RAW_SALES,
    Lake,
    drop_partitions,
    read_days,
    read_months,
    write_partitions,
)
from ..sources.sales import SALE_TYPES
from . import control

CURATED_TYPES = SALE_TYPES | COST_TYPES


class DayCounts(dict):
    """Rows per day of a load; ``undated`` counts the rows without a date."""

    undated = 0


class _Verdict:
    """A collected report: rows per scope and the first scope that failed.

    One short row per day (or month) of the requested range reaches the
    driver, which has to return those counts anyway.
    """

    def __init__(self, report: DataFrame):
        scope = report.columns[0]
        rows = sorted(report.collect(), key=lambda r: r[scope])
        self.rows = {r[scope]: r["n_rows"] for r in rows}
        self.content = {r[scope]: ":".join(str(r[n]) for n in SUMS) for r in rows if SUMS[0] in r}
        failing = [r for r in rows if r["issues"]]
        self.issues = {r[scope]: r["issues"] for r in failing}
        self.failed = failing[0][scope] if failing else None
        self.broken = failing[0]["issues"] if failing else []

    def good(self) -> list[dt.date]:
        """Scopes with rows that break no rule, those behind a failing one included."""
        return [s for s in self.rows if s not in self.issues]

    def passed(self) -> list[dt.date]:
        """Scopes with rows before the first failing one."""
        return [s for s in self.rows if self.failed is None or s < self.failed]

    def raise_if_failed(self, context: str) -> None:
        if self.failed is not None:
            raise RulesBroken(context, self.broken)


@contextmanager
def _staged(rows: DataFrame) -> Iterator[DataFrame]:
    """The rows written once as Parquet below the shared folder, for one job."""
    spark = rows.sparkSession
    with scratch(spark, "stage") as folder:
        rows.write.parquet(f"{folder}/rows")
        yield spark.read.schema(rows.schema).parquet(f"{folder}/rows")


@contextmanager
def _identified(sales: DataFrame) -> Iterator[DataFrame]:
    """Sales with an id; without one, the position inside the day serves.

    Positions follow the order of the sale's own columns, so that a repeated
    run numbers the same rows alike. The numbered rows are kept for one job.
    """
    if "car_id" in sales.columns:
        yield sales
        return
    order = sorted(set(sales.columns) - {"date"})
    with scratch(sales.sparkSession, "positions") as folder:
        placed = with_position(sales, order, "car_id", folder)
        yield placed.withColumn("car_id", F.col("car_id").cast("string"))


def _declared(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """The declared columns with their types, absent ones as nulls, then the others."""
    declared = [
        (F.col(name) if name in rows.columns else F.lit(None)).cast(kind).alias(name)
        for name, kind in types.items()
    ]
    return rows.select(*declared, *[F.col(c) for c in rows.columns if c not in types])


def backfill(
    sales: DataFrame,
    start: dt.date,
    end: dt.date,
    lake: Lake,
    limits: Limits = Limits(),
    *,
    stage: bool = True,
) -> DayCounts:
    """Write the raw days of an inclusive range; rows per day, zeros included.

    A day without sales writes nothing and leaves an older partition alone.
    Rows without a date cannot be placed; they are counted in ``undated``.
    The rules judge the staged rows that are then written. ``stage=False`` is
    for sources that cannot change meanwhile, such as stored Parquet.
    """
    days = day_range(start, end)
    within = F.col("date").between(F.lit(start), F.lit(end)) | F.col("date").isNull()
    chosen = sales.where(within)
    if stage:
        with _staged(chosen) as frozen:
            return _load(frozen, days, lake, limits)
    return _load(chosen, days, lake, limits)


def _write_raw(good: DataFrame, lake: Lake) -> None:
    declared = _declared(good, SALE_TYPES).withColumn(DAY_PARTITION, F.col("date"))
    write_partitions(declared, lake.path(RAW_SALES), DAY_PARTITION, ["dealer_name"])


def load_good_days(
    sales: DataFrame, lake: Lake, limits: Limits = Limits()
) -> dict[dt.date, RulesBroken]:
    """Write the raw days that keep the rules, all in one job; what the other days broke."""
    with (
        _staged(sales.where(F.col("date").isNotNull())) as frozen,
        _identified(frozen) as dated,
    ):
        verdict = _Verdict(raw_report(dated, by="date", limits=limits))
        good = verdict.good()
        if good:
            whole = len(good) == len(verdict.rows)
            _write_raw(dated if whole else dated.where(F.col("date").isin(good)), lake)
    return {d: RulesBroken(f"raw {d}", issues) for d, issues in verdict.issues.items()}


def drop_days(spark: SparkSession, days: list[dt.date], lake: Lake) -> None:
    """Remove days that have no sales any more from both layers, and rebuild their months."""
    if not days:
        return
    control.remember(spark, lake, days)
    for layer in (RAW_SALES, CURATED_SALES):
        drop_partitions(spark, lake.path(layer), DAY_PARTITION, [str(d) for d in days])
    build_months(spark, {d.replace(day=1) for d in days}, lake)


def _load(chosen: DataFrame, days: list[dt.date], lake: Lake, limits: Limits) -> DayCounts:
    with _identified(chosen.where(F.col("date").isNotNull())) as dated:
        verdict = _Verdict(raw_report(dated, by="date", limits=limits))
        passed = verdict.passed()
        if passed:
            _write_raw(dated.where(F.col("date") <= F.lit(passed[-1])), lake)
    verdict.raise_if_failed(f"raw {verdict.failed}")
    counts = DayCounts((day, verdict.rows.get(day, 0)) for day in days)
    counts.undated = chosen.where(F.col("date").isNull()).count()
    return counts


def ingest_day(sales: DataFrame, day: dt.date, lake: Lake, limits: Limits = Limits()) -> int:
    return backfill(sales, day, day, lake, limits)[day]


def curate_range(
    spark: SparkSession,
    start: dt.date,
    end: dt.date,
    lake: Lake,
    limits: Limits = Limits(),
    *,
    again: bool = False,
) -> dict[dt.date, int]:
    """Enrich the raw days of a range, then rebuild each month they touch.

    Days whose raw rows are the ones they were curated from, under the same
    limits, are left as they are; ``again`` curates them all the same.
    """
    return _curate(spark, start, end, lake, limits, monthly=True, again=again)[0]


def curate_good_days(
    spark: SparkSession, days: list[dt.date], lake: Lake, limits: Limits = Limits()
) -> dict[dt.date, RulesBroken]:
    """Curate some raw days and rebuild their months; what the days that break a rule broke."""
    if not days:
        return {}
    start, end, chosen = min(days), max(days), set(days)
    _, broken = _curate(
        spark, start, end, lake, limits, monthly=True, again=False, chosen=chosen, go_on=True
    )
    return broken


def curate_day(
    spark: SparkSession, day: dt.date, lake: Lake, limits: Limits = Limits(), *, again: bool = False
) -> int:
    """Enrich one raw day without rebuilding its month."""
    return _curate(spark, day, day, lake, limits, monthly=False, again=again)[0][day]


def _enriched(raw: DataFrame) -> DataFrame:
    return _declared(add_costs(raw), CURATED_TYPES)


def _source_key(limits: Limits) -> Column:
    return F.concat(F.col("fingerprint"), F.lit(f" {limits.margin} {limits.rounding_tolerance}"))


def _raw_days(raw: DataFrame, limits: Limits) -> DataFrame:
    """(sale_date, n_rows, fingerprint, source): one pass over the raw rows."""
    return fingerprints(raw, DAY_PARTITION, tuple(SALE_TYPES)).withColumn("source", _source_key(limits))


def raw_states(
    spark: SparkSession, start: dt.date, end: dt.date, lake: Lake, limits: Limits = Limits()
) -> DataFrame | None:
    """(day, n_rows, known) of the raw days of a range: whether curating would leave them alone."""
    raw = read_days(spark, lake.path(RAW_SALES), start, end, SALE_TYPES)
    if raw is None:
        return None
    records = control.read_days(spark, lake)
    return control.day_states(_raw_days(raw, limits), records, DAY_PARTITION, F.col("source"))


def reconcile_days(spark: SparkSession, start: dt.date, end: dt.date, lake: Lake) -> DataFrame | None:
    """The stored curated days of a range judged against the stored raw days, content included."""
    raw, curated = (
        read_days(spark, lake.path(layer), start, end, types)
        for layer, types in ((RAW_SALES, SALE_TYPES), (CURATED_SALES, CURATED_TYPES))
    )
    if raw is None or curated is None:
        return None
    return curated_report(curated, raw, by=DAY_PARTITION, content=tuple(SALE_TYPES))


def _curate(
    spark: SparkSession,
    start: dt.date,
    end: dt.date,
    lake: Lake,
    limits: Limits,
    *,
    monthly: bool,
    again: bool,
    chosen: set[dt.date] | None = None,
    go_on: bool = False,
) -> tuple[dict[dt.date, int], dict[dt.date, RulesBroken]]:
    """Write the curated days that changed and pass: rows per day, and what others broke.

    A day that breaks a rule stops the days behind it and is raised, unless the
    run is to ``go_on``. The rows are hashed once, into the staged copy. The rules compare what was
    staged with what the raw layer holds. The records of days about to be
    written are dropped first and come back last, so that a run that fails in
    between does them again.
    """
    counts = dict.fromkeys(day_range(start, end), 0)
    raw = read_days(spark, lake.path(RAW_SALES), start, end, SALE_TYPES)
    if raw is None:
        return counts, {}
    if chosen is not None and len(chosen) < len(counts):
        raw = raw.where(F.col(DAY_PARTITION).isin(sorted(chosen)))
    # one short row per day of the range
    found = {r[DAY_PARTITION]: r for r in _raw_days(raw, limits).collect()}
    known = control.known_days(spark, lake, list(found))
    changed = sorted(d for d, r in found.items() if again or not _up_to_date(known.get(d), r, monthly))
    counts |= {d: r["n_rows"] for d, r in found.items()}
    if not changed:
        return counts, {}
    stale = raw if len(changed) == len(found) else raw.where(F.col(DAY_PARTITION).isin(changed))
    kinds = f"{DAY_PARTITION} date, n_rows long, " + ", ".join(f"{n} decimal(38,0)" for n in SUMS)
    fields = (DAY_PARTITION, "n_rows", *SUMS)
    sums = spark.createDataFrame([tuple(found[d][f] for f in fields) for d in changed], kinds)
    with _staged(_enriched(stale)) as curated:
        shared = tuple(SALE_TYPES)
        verdict = _Verdict(
            curated_report(curated, sums, DAY_PARTITION, limits, content=shared, counted=True)
        )
        passed = verdict.good() if go_on else verdict.passed()
        if passed:
            control.remember(spark, lake, [d for d in passed if d in known])
            whole = len(passed) == len(changed)
            good = curated if whole else curated.where(F.col(DAY_PARTITION).isin(passed))
            write_partitions(good, lake.path(CURATED_SALES), DAY_PARTITION, ["dealer_name"])
    finished = go_on or verdict.failed is None
    if monthly and finished:
        build_months(spark, {d.replace(day=1) for d in passed}, lake)
    records = [
        control.DayRecord(d, found[d]["n_rows"], found[d]["source"], verdict.content[d], monthly and finished)
        for d in passed
    ]
    control.remember(spark, lake, (), records)
    if not go_on:
        verdict.raise_if_failed(f"curated {verdict.failed}")
    broken = {d: RulesBroken(f"curated {d}", issues) for d, issues in verdict.issues.items()}
    return counts, broken


def _up_to_date(record: control.DayRecord | None, raw: Row, monthly: bool) -> bool:
    return record is not None and record.source == raw["source"] and (record.monthly or not monthly)


def _drop_months(spark: SparkSession, months: list[dt.date], lake: Lake) -> None:
    labels = [f"{m:%Y-%m}" for m in months]
    for layer in (CURATED_EXPENSES, CURATED_TARGETS):
        drop_partitions(spark, lake.path(layer), MONTH_PARTITION, labels)


def build_months(
    spark: SparkSession, months: Iterable[dt.date], lake: Lake
) -> dict[dt.date, int]:
    """Expenses and targets of whole months, from all their curated days.

    A month whose curated days are gone loses its rows in both tables.
    """
    wanted = sorted(set(months))
    curated = read_months(spark, lake.path(CURATED_SALES), wanted, CURATED_TYPES)
    if curated is None:
        _drop_months(spark, wanted, lake)
        return {}
    # one small row per dealer and month, read by the gate and by both writers
    base = monthly_base(curated).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        expenses, targets = monthly_expenses(base), monthly_targets(base)
        verdict = _Verdict(monthly_report(expenses, targets, by="mes"))
        passed = verdict.passed()
        if passed:
            label = month_label(F.col("mes"))
            for table, layer in ((expenses, CURATED_EXPENSES), (targets, CURATED_TARGETS)):
                good = table.where(F.col("mes") <= F.lit(passed[-1]))
                write_partitions(
                    good.withColumn(MONTH_PARTITION, label),
                    lake.path(layer),
                    MONTH_PARTITION,
                    ["dealer_name"],
                )
        if verdict.failed is not None:
            verdict.raise_if_failed(f"tablas mensuales {verdict.failed:%Y-%m}")
        _drop_months(spark, [m for m in wanted if m not in verdict.rows], lake)
        return verdict.rows
    finally:
        base.unpersist()


def run_daily(
    sales: DataFrame, day: dt.date, lake: Lake, limits: Limits = Limits()
) -> tuple[int, int]:
    """Load and curate one day: rows in raw, rows in curated."""
    raw_rows = ingest_day(sales, day, lake, limits)
    curated = curate_range(sales.sparkSession, day, day, lake, limits)
    return raw_rows, curated[day]


def run_replayed_day(
    sales: DataFrame, today: dt.date, year: int, lake: Lake, limits: Limits = Limits()
) -> tuple[int, int]:
    """Run today's calendar day inside the replayed year."""
    return run_daily(sales, replay_day(today, year), lake, limits)


def day_counts(rows: DataFrame, start: dt.date, end: dt.date, day: str) -> DataFrame:
    """Rows per calendar day of a range, days without rows included."""
    one = rows.sparkSession.range(1)
    calendar = one.select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias(day))
    counted = rows.groupBy(day).agg(F.count(F.lit(1)).alias("n"))
    return calendar.join(counted, day, "left").select(day, F.coalesce("n", F.lit(0)).alias("n"))
