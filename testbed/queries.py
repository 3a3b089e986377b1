"""One entry per query: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldero.functions.dates import month_label, replay_date
from saldero.functions.keyed import keyed_uniform
from saldero.functions.money import decimals_to_double
from saldero.operators import quality
from saldero.operators.enrich import add_costs, with_position
from saldero.operators.ranking import top_n, with_leader
from saldero.operators.timeintel import moving_mean_7d, with_previous_month
from saldero.operators.waterfall import INPUTS, waterfall
from saldero.plans import jobs, marts, page, report, warehouse
from saldero.plans.id_index import id_index
from saldero.plans.metrics import derive, evaluate, with_grand_total
from saldero.session import scratch_path
from saldero.sources.lake import (
    CURATED_EXPENSES,
    CURATED_SALES,
    CURATED_TARGETS,
    DAY_PARTITION,
    MONTH_PARTITION,
    RAW_SALES,
    Lake,
    drop_partitions,
    read_layer,
    read_months,
    write_partitions,
)
from saldero.sources.sales import load_source

from . import tables as t

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return decimals_to_double(build(spark, sf_dir))

        run.__doc__ = build.__doc__
        _QUERIES[name] = run
        return build

    return register


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- scalar functions and enrichment -----------------------------------------


@_query("F1_keyed_uniform")
def _uniform(spark, sf):
    return t.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("car_id"),
        keyed_uniform(0.0, 1.0, "ruido", "o_orderkey").alias("u"),
    )


@_query("F10_replay_date")
def _replay(spark, sf):
    day = F.to_date("o_orderdate")
    return t.table(spark, sf, "orders").select(
        "o_orderkey",
        day.alias("day"),
        replay_date(day, 2022).alias("replay_2022"),
        replay_date(day, 2020).alias("replay_2020"),
    )


@_query("E_enriched_sales")
def _enriched(spark, sf):
    return t.curated(spark, sf)


@_query("E9_position_key")
def _positions(spark, sf):
    """Costs of a source without ids, keyed by the position inside the day."""
    named = t.sales(spark, sf).withColumn("ticket", F.col("car_id").cast("bigint"))
    placed = with_position(named.drop("car_id"), ["ticket"])
    return add_costs(placed, "position").select(
        "ticket", "date", "position", "costo", "utilidad_bruta"
    )


@_query("E_monthly_expenses")
def _expenses(spark, sf):
    return t.monthly_tables(spark, sf)[0]


@_query("E_monthly_targets")
def _targets(spark, sf):
    return t.monthly_tables(spark, sf)[1]


# --- marts ---------------------------------------------------------------------


@_query("S14_typed_sales")
def _typed(spark, sf):
    return t.ventas(spark, sf)


@_query("P2_wide_prices")
def _wide_prices(spark, sf):
    """Prices beyond nine integer digits and below a cent, typed and summed."""
    typed = marts.typed_sales(add_costs(t.wide_sales(spark, sf)))
    return typed.groupBy("dealer_name").agg(
        F.count("precio").alias("n"), F.sum("precio").alias("precio")
    )


@_query("A1_kpi_daily")
def _kpi_daily(spark, sf):
    return t.marts(spark, sf).views()["kpi_diario"]


@_query("A2_kpi_monthly")
def _kpi_monthly(spark, sf):
    return t.marts(spark, sf).kpi_mensual


@_query("A1_kpi_daily_lineitem")
def _kpi_daily_lines(spark, sf):
    return t.line_marts(spark, sf).views()["kpi_diario"]


@_query("A2_kpi_monthly_lineitem")
def _kpi_monthly_lines(spark, sf):
    return t.line_marts(spark, sf).kpi_mensual


@_query("J1_kpi_over_tables")
def _kpi_joined(spark, sf):
    expenses, targets = t.monthly_tables(spark, sf)
    return marts.kpi_monthly(
        t.ventas(spark, sf), marts.typed_expenses(expenses), marts.typed_targets(targets)
    )


@_query("J1_left_join_misses")
def _kpi_with_misses(spark, sf):
    """March has no expenses and November no targets."""
    expenses, targets = t.monthly_tables(spark, sf)
    return marts.kpi_monthly(
        t.ventas(spark, sf),
        marts.typed_expenses(expenses.where(F.month("mes") != 3)),
        marts.typed_targets(targets.where(F.month("mes") != 11)),
    )


@_query("G1_dim_date")
def _dim_date(spark, sf):
    return t.marts(spark, sf).dim_fecha


@_query("G2_dim_dealer")
def _dim_dealer(spark, sf):
    return t.marts(spark, sf).dim_concesionaria


@_query("G3_dim_month")
def _dim_month(spark, sf):
    return t.marts(spark, sf).dim_mes


@_query("G5_calendar")
def _calendar(spark, sf):
    return marts.report_calendar(t.marts(spark, sf).dim_fecha)


# --- data quality ----------------------------------------------------------------


@_query("Q_raw_issues")
def _raw_issues(spark, sf):
    limits = quality.Limits(max_price=t.TIGHT_MAX_PRICE)
    return quality.issues_of(quality.raw_report(t.faulty_sales(spark, sf), limits=limits))


@_query("Q_raw_duplicates")
def _raw_duplicates(spark, sf):
    frame = t.faulty_sales(spark, sf)
    return quality.repeated_keys(frame, "date", "car_id")


@_query("Q_raw_blank")
def _raw_blank(spark, sf):
    frame = t.faulty_sales(spark, sf)
    found = quality.issues_of(quality.raw_report(frame, by="company"))
    return found.where(F.col("check") == quality.BLANKS)


@_query("Q_curated_issues")
def _curated_issues(spark, sf):
    return quality.issues_of(quality.curated_report(*t.faulty_curated(spark, sf)))


@_query("Q_monthly_issues")
def _monthly_issues(spark, sf):
    return quality.issues_of(quality.monthly_report(*t.faulty_monthly(spark, sf)))


@_query("Q_key_coverage")
def _key_coverage(spark, sf):
    found = quality.issues_of(quality.monthly_report(*t.faulty_monthly(spark, sf)))
    return found.where(F.col("check") == quality.RECONCILIATION).select("mes", "n")


@_query("Q18_gate")
def _gate(spark, sf):
    """The message a gate would raise with, per failing day."""
    limits = quality.Limits(max_price=t.TIGHT_MAX_PRICE)
    report_ = quality.raw_report(t.faulty_sales(spark, sf), limits=limits)
    texts = F.transform("issues", lambda i: F.concat(i["check"], F.lit(": "), i["detail"]))
    return report_.where(F.size("issues") > 0).select(
        F.concat(
            F.lit("raw "),
            F.col("date").cast("string"),
            F.lit(": "),
            F.size("issues").cast("string"),
            F.lit(" problema(s) -> "),
            F.array_join(texts, "; "),
        ).alias("message")
    )


@_query("T9_regions_per_dealer")
def _regions(spark, sf):
    """Segments stand for dealers, so that each one has several regions."""
    named = t.ventas(spark, sf).withColumn("dealer_name", F.col("company"))
    return quality.regions_per_dealer(named)


# --- source and lake ----------------------------------------------------------------


def _lake(spark: SparkSession, purpose: str) -> Lake:
    return Lake(scratch_path(spark, purpose))


def staged(rows: DataFrame, purpose: str) -> DataFrame:
    """Rows as they are now, before what they are read from changes."""
    path = f"{scratch_path(rows.sparkSession, purpose)}/rows"
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _bounds(rows: DataFrame) -> tuple[dt.date, dt.date]:
    found = rows.agg(F.min("date").alias("first"), F.max("date").alias("last")).first()
    return found["first"], found["last"]


@_query("S1_csv_ingest")
def _csv(spark, sf):
    path = f"{scratch_path(spark, 'csv')}/source"
    t.source_sales(spark, sf).write.option("header", "true").csv(path)
    return load_source(spark, path)


def _dated_loads(spark, sf, formats) -> DataFrame:
    """The orders as one CSV per date format, loaded and counted by day."""
    # joined once, written in each format
    orders, loaded = staged(t.source_sales(spark, sf), "orders"), []
    for number, date_format in enumerate(formats):
        path = f"{scratch_path(spark, 'dates')}/source"
        text = F.date_format("Date", date_format).alias("Date")
        orders.withColumn("Date", text).write.option("header", "true").csv(path)
        loaded.append(load_source(spark, path).select(F.lit(number).alias("format"), "date"))
    return reduce(DataFrame.union, loaded).groupBy("format", "date").agg(
        F.count(F.lit(1)).alias("n")
    )


@_query("S3_date_formats")
def _date_formats(spark, sf):
    return _dated_loads(spark, sf, t.DATE_FORMATS)


@_query("S3_date_shapes")
def _date_shapes(spark, sf):
    """Month names in full, dots, two-digit years, weekdays, clock times and offsets."""
    return _dated_loads(spark, sf, t.DATE_SHAPES)


@_query("Q7_price_type")
def _price_type(spark, sf):
    """Prices with a letter behind the digits are text, and the type rule says so."""
    path, priced = f"{scratch_path(spark, 'prices')}/source", t.source_sales(spark, sf)
    odd = F.when(F.col("Car_id") % 97 == 0, F.concat(F.col("Price ($)").cast("string"), F.lit("d")))
    text = F.coalesce(odd, F.col("Price ($)").cast("string"))
    priced.withColumn("Price ($)", text).write.option("header", "true").csv(path)
    found = quality.issues_of(quality.raw_report(load_source(spark, path)))
    return found.where(F.col("check") == quality.TYPE).select("date", "check", "n")


@_query("S14_schema_drift")
def _schema_drift(spark, sf):
    """Typed sales of a lake whose later days came first and whose first days lack the region."""
    rows, lake = t.sales(spark, sf), _lake(spark, "drift")
    first, last = _bounds(rows)
    jobs.backfill(rows, t.DRIFT, last, lake)
    jobs.backfill(rows.drop("dealer_region"), first, t.DRIFT - dt.timedelta(days=1), lake)
    jobs.curate_range(spark, first, last, lake)
    warehouse.refresh_tables(spark, lake)
    return warehouse.open_tables(spark, lake)["ventas"]


@_query("S8_backfill_counts")
def _backfill(spark, sf):
    rows, lake = t.sales(spark, sf), _lake(spark, "backfill")
    first, last = _bounds(rows)
    jobs.backfill(rows, first, last, lake)
    raw = read_layer(spark, lake.path(RAW_SALES))
    return jobs.day_counts(raw, first, last, "date")


def _loaded_lake(spark: SparkSession, sf: str, purpose: str) -> tuple[Lake, dt.date, dt.date]:
    rows, lake = t.sales(spark, sf), _lake(spark, purpose)
    first, last = _bounds(rows)
    jobs.backfill(rows, first, last, lake)
    jobs.curate_range(spark, first, last, lake)
    return lake, first, last


@_query("I3_lake_roundtrip")
def _roundtrip(spark, sf):
    lake, _, _ = _loaded_lake(spark, sf, "roundtrip")
    warehouse.refresh_warehouse(spark, lake)
    return warehouse.open_marts(spark, lake).kpi_mensual


@_query("S17_stored_marts")
def _stored_marts(spark, sf):
    """The dealer matrix from mart views that were stored and read back."""
    lake = _lake(spark, "stored")
    return report.dealer_matrix(warehouse.import_marts(spark, lake, t.marts(spark, sf)))


@_query("I5_idempotent")
def _idempotent(spark, sf):
    """Everything run twice over the same lake."""
    lake, first, last = _loaded_lake(spark, sf, "idempotent")
    jobs.backfill(t.sales(spark, sf), first, last, lake)
    jobs.curate_range(spark, first, last, lake)
    warehouse.refresh_tables(spark, lake)
    warehouse.refresh_tables(spark, lake)
    return warehouse.open_tables(spark, lake)["ventas"].select(
        "car_id", "fecha", "mes", "dealer_name", "dealer_region", "company", "model",
        "precio", "costo", "utilidad_bruta",
    )


@_query("I2_month_rebuild")
def _month_rebuild(spark, sf):
    """Two ranges that meet inside a month: the second run rebuilds that month whole."""
    rows, lake = t.sales(spark, sf), _lake(spark, "rebuild")
    first, last = _bounds(rows)
    middle = dt.date(1998, 6, 13)
    jobs.backfill(rows, first, last, lake)
    jobs.curate_range(spark, first, middle, lake)
    jobs.curate_range(spark, middle + dt.timedelta(days=1), last, lake)
    expenses = read_layer(spark, lake.path(CURATED_EXPENSES))
    targets = read_layer(spark, lake.path(CURATED_TARGETS)).select(
        "dealer_name", "mes", "objetivo_ventas"
    )
    return expenses.drop("month").join(targets, ["dealer_name", "mes"], "full_outer")


@_query("I6_month_refresh")
def _month_refresh(spark, sf):
    """Typed sales built in full, then again for two months only."""
    lake = _lake(spark, "refresh")
    expenses, targets = t.monthly_tables(spark, sf)
    sold = t.curated(spark, sf).withColumn(DAY_PARTITION, F.col("date"))
    write_partitions(sold, lake.path(CURATED_SALES), DAY_PARTITION)
    label = month_label(F.col("mes"))
    for table, layer in ((expenses, CURATED_EXPENSES), (targets, CURATED_TARGETS)):
        write_partitions(
            table.withColumn(MONTH_PARTITION, label), lake.path(layer), MONTH_PARTITION
        )
    warehouse.refresh_tables(spark, lake)
    warehouse.refresh_months(spark, lake, [dt.date(1997, 2, 1), dt.date(1999, 12, 1)])
    return marts.sales_by_month(warehouse.open_tables(spark, lake)["ventas"])


def _store_months(spark: SparkSession, lake: Lake, sold: DataFrame, months: list[dt.date]) -> None:
    """The curated layer of some months, old days removed, with their monthly tables."""
    path = lake.path(CURATED_SALES)
    days = [m + dt.timedelta(days=n) for m in months for n in range(31)]
    drop_partitions(spark, path, DAY_PARTITION, [str(d) for d in days if d.replace(day=1) in months])
    write_partitions(sold.where(F.col("mes").isin(months)), path, DAY_PARTITION)
    jobs.build_months(spark, months, lake)


@_query("I6_mart_merge")
def _mart_merge(spark, sf):
    """Stored marts after merges of a changed month, a lost one and a late one."""
    lake, sold = _lake(spark, "merge"), t.curated(spark, sf).withColumn(DAY_PARTITION, F.col("date"))
    early = sold.where(F.col("mes") != t.LATE)
    write_partitions(early, lake.path(CURATED_SALES), DAY_PARTITION)
    jobs.build_months(spark, [r["mes"] for r in early.select("mes").distinct().collect()], lake)
    warehouse.refresh_tables(spark, lake)
    warehouse.merge_marts(spark, lake)
    fewer = sold.where(F.col("company") != "BUILDING")
    for month, rows in ((t.CHANGED, fewer), (t.LOST, sold.limit(0)), (t.LATE, sold)):
        _store_months(spark, lake, rows, [month])
        warehouse.refresh_months(spark, lake, [month])
        warehouse.merge_marts(spark, lake)
    return warehouse.open_stored_marts(spark, lake).kpi_mensual


@_query("S17_snapshot_reads")
def _snapshot_reads(spark, sf):
    """The daily fact of two publications, the first one read after the second was made."""
    lake, sold = _lake(spark, "snapshots"), t.curated(spark, sf)
    tables = warehouse.mart_set(spark, lake)
    warehouse.import_marts(spark, lake, marts.Marts.from_curated(sold))
    first = tables.current()
    fewer = sold.where(F.col("company") != "HOUSEHOLD")
    warehouse.import_marts(spark, lake, marts.Marts.from_curated(fewer))
    reads = [
        tables.read("kpi_diario", v).drop("mes").withColumn("version", F.lit(v.number))
        for v in (first, tables.current())
    ]
    return reads[0].union(reads[1])


@_query("I5_fingerprints")
def _fingerprints(spark, sf):
    """Which days a second load changed, by the content of their rows, before and after curating."""
    lake, first, last = _loaded_lake(spark, sf, "prints")
    dearer = (F.month("date") == t.CHANGED.month) & (F.col("company") == "BUILDING")
    price = F.when(dearer, F.col("price") + F.lit(1.0)).otherwise(F.col("price"))
    jobs.backfill(t.sales(spark, sf).withColumn("price", price), first, last, lake)
    before = staged(jobs.raw_states(spark, first, last, lake), "states")
    jobs.curate_range(spark, first, last, lake)
    after = jobs.raw_states(spark, first, last, lake).select("day", F.col("known").alias("known_after"))
    return before.join(after, "day")


@_query("Q10_swapped_rows")
def _swapped(spark, sf):
    """Days whose curated rows have been changed behind the back of the jobs, at equal counts."""
    lake, first, last = _loaded_lake(spark, sf, "swapped")
    month = read_months(spark, lake.path(CURATED_SALES), [t.CHANGED], jobs.CURATED_TYPES)
    company = F.when(F.col("company") == "BUILDING", F.lit("FURNITURE")).otherwise(F.col("company"))
    changed = staged(month.withColumn("company", company), "changed")
    write_partitions(changed, lake.path(CURATED_SALES), DAY_PARTITION)
    found = quality.issues_of(jobs.reconcile_days(spark, first, last, lake))
    return found.select(F.col(DAY_PARTITION).alias("date"), "check", "detail", "n")


@_query("Q6_across_days")
def _across_days(spark, sf):
    """Rows per day whose id was sold on another day before the last year, by the index of ids."""
    named = t.orders_with_customer(spark, sf).select(
        F.col("o_custkey").cast("string").alias("car_id"),
        F.to_date("o_orderdate").alias("date"),
        F.col("n_name").alias("dealer_name"),
        F.col("r_name").alias("dealer_region"),
        F.col("c_mktsegment").alias("company"),
        F.col("o_orderpriority").alias("model"),
        F.col("o_totalprice").alias("price"),
    )
    lake = _lake(spark, "ids")
    history = named.where(F.col("date") < F.lit(t.DRIFT)).withColumn(DAY_PARTITION, F.col("date"))
    write_partitions(history, lake.path(RAW_SALES), DAY_PARTITION)
    months = [r[0] for r in history.select(F.trunc("date", "month")).distinct().collect()]
    with id_index(spark, lake, buckets=8) as index:
        index.refresh(months)
        return staged(index.across_days(named.where(F.col("date") >= F.lit(t.DRIFT))), "across")


@_query("S14_clustered")
def _clustered(spark, sf):
    """Typed sales of some dealers, from files that hold ranges of dealers."""
    lake, _, _ = _loaded_lake(spark, sf, "clustered")
    warehouse.refresh_tables(spark, lake)
    sold = warehouse.open_tables(spark, lake)["ventas"]
    return sold.where(F.col("dealer_name").isin(list(t.DEALER_SLICE.dealers)))


@_query("I7_partial_failure")
def _partial(spark, sf):
    """Raw rows per day after a backfill that stops at the first bad day."""
    rows, lake = t.late_fault_sales(spark, sf), _lake(spark, "partial")
    first, last = _bounds(rows)
    try:
        jobs.backfill(rows, first, last, lake)
    except quality.RulesBroken:
        pass
    raw = read_layer(spark, lake.path(RAW_SALES))
    return raw.groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@_query("I4_daily_run")
def _daily_run(spark, sf):
    """One replayed day loaded and curated over an empty lake."""
    rows, lake = t.sales(spark, sf), _lake(spark, "daily")
    _, last = _bounds(rows)
    jobs.run_replayed_day(rows, last.replace(year=last.year + 25), last.year, lake)
    return read_layer(spark, lake.path(CURATED_SALES)).drop("sale_date")


# --- measures -------------------------------------------------------------------------

_AMOUNTS = [
    "num_ventas", "ventas", "costo", "utilidad_bruta", "opex", "ebitda", "utilidad_neta",
    "objetivo_ventas",
]
_RATIOS = [
    "margen_bruto", "margen_ebitda", "margen_neto", "ticket_promedio", "cumplimiento", "brecha",
    "pp_vs_objetivo",
]
_DAILY = ["num_ventas_dia", "ventas_dia", "costo_dia", "utilidad_bruta_dia", "margen_bruto_dia"]


@_query("A6_metrics_by_dealer")
def _by_dealer(spark, sf):
    return evaluate(t.marts(spark, sf).kpi_mensual, ["dealer_name"], _AMOUNTS + _RATIOS)


@_query("A6_metrics_by_region")
def _by_region(spark, sf):
    star = report.star_monthly(t.marts(spark, sf))
    return evaluate(star, ["region", "mes"], _AMOUNTS + _RATIOS)


@_query("A7_daily_metrics")
def _by_day(spark, sf):
    star = report.star_daily(t.marts(spark, sf))
    return evaluate(star, ["region", "anio_mes"], _DAILY)


@_query("A14_rollup")
def _rollup(spark, sf):
    return with_grand_total(t.marts(spark, sf).kpi_mensual, ["dealer_name"], _AMOUNTS + _RATIOS)


@_query("W1_moving_avg_7d")
def _mean(spark, sf):
    m = t.marts(spark, sf)
    return moving_mean_7d(m.kpi_diario, m.dim_fecha)


@_query("W1_moving_avg_dealer")
def _mean_dealer(spark, sf):
    m = t.marts(spark, sf)
    return moving_mean_7d(m.kpi_diario, m.dim_fecha, ["dealer_name"])


@_query("W2_prev_month")
def _previous(spark, sf):
    m = t.marts(spark, sf)
    return with_previous_month(m.kpi_mensual, m.dim_mes).select(
        "mes", "ventas", "ventas_mes_anterior"
    )


@_query("W3_mom")
def _mom(spark, sf):
    m = t.marts(spark, sf)
    rows = with_previous_month(m.kpi_mensual, m.dim_mes, ["dealer_name"])
    return derive(rows, ["color_vs_mes_anterior"])


@_query("W3_mom_lineitem")
def _mom_lines(spark, sf):
    m = t.line_marts(spark, sf)
    return with_previous_month(m.kpi_mensual, m.dim_mes, ["dealer_name"])


@_query("W4_top_dealer")
def _leader(spark, sf):
    star = report.star_monthly(t.marts(spark, sf))
    dealers = evaluate(star, ["dealer_name", "region"], ["ventas"])
    return derive(with_leader(dealers, dealers), ["color_barra", "fondo_top"])


@_query("O2_top10")
def _top(spark, sf):
    return top_n(evaluate(t.marts(spark, sf).kpi_mensual, ["dealer_name"], ["ventas"]))


@_query("O2_top10_lineitem")
def _top_lines(spark, sf):
    return top_n(evaluate(t.line_marts(spark, sf).kpi_mensual, ["dealer_name"], ["ventas"]))


@_query("W5_waterfall")
def _waterfall(spark, sf):
    totals = evaluate(t.marts(spark, sf).kpi_mensual, ["mes"], list(INPUTS))
    return waterfall(totals)


# --- report queries -----------------------------------------------------------------------


@_query("P10_selection")
def _selection(spark, sf):
    return report.by_dealer_and_month(t.marts(spark, sf), t.SLICE)


@_query("P12_scope_override")
def _override(spark, sf):
    return report.sales_against_target(t.marts(spark, sf), t.SLICE)


@_query("P13_bands")
def _bands(spark, sf):
    m = t.marts(spark, sf)
    names = [
        "color_cumplimiento", "color_fuente_cumplimiento", "color_ebitda", "color_fuente_ebitda",
        "color_margen_bruto", "color_margen_neto", "color_brecha", "color_pp",
    ]
    return evaluate(m.kpi_mensual, ["dealer_name", "mes"], names)


def _report(name: str, build: Callable, selection=report.EVERYTHING) -> None:
    _query(name)(lambda spark, sf: build(t.marts(spark, sf), selection))


_report("R1_cards", report.headline_cards)
_report("R1_cards_sliced", report.headline_cards, t.SLICE)
_report("R2_secondary_cards", report.secondary_cards)
_report("R2_secondary_cards_sliced", report.secondary_cards, t.DEALER_SLICE)
_report("R3_sales_vs_target", report.sales_against_target)
_report("R4_margin_trend", report.margin_trend, t.DEALER_SLICE)
_report("R5_waterfall_columns", report.waterfall_report, t.SLICE)
_report("R6_ranking", report.dealer_ranking, t.SLICE)
_report("R7_attainment_top10", report.attainment_of_top)
_report("R8_dealer_matrix", report.dealer_matrix)
_report("R8_dealer_matrix_sliced", report.dealer_matrix, t.DEALER_SLICE)
_report("J2_region_matrix", report.region_matrix, t.SLICE)
_report("R9_ops_cards", report.operations_cards, t.SLICE)
_report("R10_daily_trend", report.daily_trend)
_report("R10_daily_trend_sliced", report.daily_trend, t.DEALER_SLICE)
_report("R11_daily_detail", report.daily_detail, t.SLICE)


def _page_visual(name: str, visual: str, selection) -> None:
    _query(name)(lambda spark, sf: page.page(t.marts(spark, sf), selection)[visual])


_page_visual("R_page_cards", "R1", t.SLICE)
_page_visual("R_page_secondary", "R2", t.DEALER_SLICE)
_page_visual("R_page_target", "R3", t.SLICE)
_page_visual("R_page_margin", "R4", t.DEALER_SLICE)
_page_visual("R_page_ranking", "R6", t.SLICE)
_page_visual("R_page_matrix", "R8", t.DEALER_SLICE)


def _stored_report(name: str, build: Callable, selection) -> None:
    def run(spark, sf):
        lake = _lake(spark, name)
        return build(warehouse.import_marts(spark, lake, t.marts(spark, sf)), selection)

    _query(name)(run)


_stored_report("R2_stored_sliced", report.secondary_cards, t.DEALER_SLICE)
_stored_report("R8_stored_sliced", report.dealer_matrix, t.DEALER_SLICE)
_stored_report("R10_stored_sliced", report.daily_trend, t.DEALER_SLICE)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly KPIs per dealer."""
    return _QUERIES["A2_kpi_monthly"](spark, sf_dir)


__all__ = ["all_queries", "flagship"]
