"""Report queries: measures at the grain and under the filters a page asks for."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..operators.ranking import top_n, with_leader
from ..operators.timeintel import month_before_latest, moving_mean_7d
from ..operators.waterfall import INPUTS, waterfall, waterfall_columns
from .marts import Marts
from .metrics import derive, evaluate, with_grand_total


@dataclass(frozen=True)
class Selection:
    """Slicer values shared by every query of a page; None means no filter."""

    months: Sequence[dt.date] | None = None
    regions: Sequence[str] | None = None
    dealers: Sequence[str] | None = None

    def all_months(self) -> Selection:
        """The same slicers without the month one (a visual it does not reach)."""
        return replace(self, months=None)

    def with_months_before(self) -> Selection:
        """The months and the one before each, what a look back of a month can reach."""
        if self.months is None:
            return self
        before = {(m.replace(day=1) - dt.timedelta(days=1)).replace(day=1) for m in self.months}
        return replace(self, months=sorted({*self.months, *before}))

    def _dealers(self, fact: DataFrame, marts: Marts) -> DataFrame:
        if self.dealers is not None:
            fact = fact.where(F.col("dealer_name").isin(list(self.dealers)))
        if self.regions is not None:
            chosen = marts.dim_concesionaria.where(F.col("region").isin(list(self.regions)))
            fact = fact.join(chosen.select("dealer_name"), "dealer_name", "left_semi")
        return fact

    def monthly(self, marts: Marts) -> DataFrame:
        return self._dealers(self._months(marts.kpi_mensual), marts)

    def daily(self, marts: Marts) -> DataFrame:
        return self._dealers(self._months(marts.kpi_diario), marts)

    def model_months(self, marts: Marts) -> DataFrame:
        """Months in context: only the month slicer reaches this dimension."""
        return self._months(marts.dim_mes)

    def days(self, rows: DataFrame) -> DataFrame:
        """Month filter on a result at day grain."""
        return self._months(rows.withColumn("mes", month_start(F.col("fecha")))).drop("mes")

    def _months(self, rows: DataFrame) -> DataFrame:
        """On ``mes`` itself, the partition column of every stored fact."""
        if self.months is None:
            return rows
        return rows.where(F.col("mes").isin(list(self.months)))


EVERYTHING = Selection()


def _by_sales(rows: DataFrame, *first: str) -> DataFrame:
    """The order of tables that rank dealers."""
    return rows.orderBy(*first, F.desc_nulls_last("ventas"), "dealer_name")


def star_monthly(marts: Marts, selection: Selection = EVERYTHING) -> DataFrame:
    """Monthly fact beside its dealer attributes, months of the model only."""
    placed = selection.monthly(marts).join(marts.dim_concesionaria, "dealer_name", "left")
    return placed.join(marts.dim_mes, "mes")


def star_daily(marts: Marts) -> DataFrame:
    """Daily fact beside its dealer, day and (through the day) month attributes."""
    daily = marts.kpi_diario.drop("mes").join(marts.dim_concesionaria, "dealer_name", "left")
    return daily.join(marts.dim_fecha, "fecha", "left")


def headline_cards(marts: Marts, selection: Selection = EVERYTHING) -> DataFrame:
    names = ["ventas", "utilidad_bruta", "ebitda", "utilidad_neta", "cumplimiento"]
    return evaluate(selection.monthly(marts), [], [*names, "color_cumplimiento"])


def secondary_cards(marts: Marts, selection: Selection = EVERYTHING) -> DataFrame:
    """Change against the previous month, margins and gap, with their bands.

    The previous month replaces the month filter: it is the month before the
    latest one in context, whatever the selection covers.
    """
    reach = selection.with_months_before().monthly(marts)
    before = month_before_latest(selection.model_months(marts))
    in_context = (
        F.lit(True) if selection.months is None else F.col("mes").isin(list(selection.months))
    )
    sums = ["ventas", "utilidad_bruta", "ebitda", "utilidad_neta", "objetivo_ventas"]
    totals = reach.withColumn("_before", before).agg(
        *[F.sum(F.when(in_context, F.col(c))).alias(c) for c in sums],
        F.sum(F.when(F.col("mes") == F.col("_before"), F.col("ventas"))).alias(
            "ventas_mes_anterior"
        ),
    )
    names = [
        "ventas_vs_mes_anterior", "margen_bruto", "margen_ebitda", "margen_neto", "brecha",
        "pp_vs_objetivo", "color_vs_mes_anterior", "color_margen_bruto", "color_ebitda",
        "color_margen_neto", "color_brecha", "color_pp",
    ]
    return derive(totals, names).select("ventas_mes_anterior", *names)


def sales_against_target(marts: Marts, selection: Selection = EVERYTHING) -> DataFrame:
    """Monthly trend; the month slicer does not reach it."""
    fact = selection.all_months().monthly(marts)
    names = ["ventas", "objetivo_ventas", "cumplimiento"]
    return evaluate(fact, ["mes"], names).orderBy("mes")


def margin_trend(marts: Marts, selection: Selection = EVERYTHING) -> DataFrame:
    """Monthly margins; the month slicer does not reach them."""
    fact = selection.all_months().monthly(marts)
    return evaluate(fact, ["mes"], ["margen_bruto", "margen_ebitda"]).orderBy("mes")


def waterfall_report(marts: Marts, selection: Selection = EVERYTHING) -> DataFrame:
    totals = evaluate(selection.monthly(marts), [], list(INPUTS))
    return waterfall_columns(waterfall(totals)).orderBy("orden")


def dealer_ranking(marts: Marts, selection: Selection = EVERYTHING) -> DataFrame:
    """Top dealers by sales, the leader highlighted."""
    dealers = evaluate(selection.monthly(marts), ["dealer_name"], ["ventas"])
    ranked = with_leader(top_n(dealers), dealers)
    names = ["color_barra"]
    shown = derive(ranked, names).select("dealer_name", "ventas", "ventas_max", "es_top", *names)
    return _by_sales(shown)


def attainment_of_top(marts: Marts, selection: Selection = EVERYTHING) -> DataFrame:
    """Target attainment of the top dealers by sales, banded."""
    names = ["ventas", "cumplimiento", "color_cumplimiento"]
    return _by_sales(top_n(evaluate(selection.monthly(marts), ["dealer_name"], names)))


def dealer_matrix(marts: Marts, selection: Selection = EVERYTHING) -> DataFrame:
    """Detail per dealer with a grand total whose ratios come from the sums."""
    names = [
        "ventas", "utilidad_bruta", "ebitda", "margen_ebitda", "cumplimiento", "utilidad_neta",
        "color_cumplimiento", "color_fuente_cumplimiento", "color_ebitda", "color_fuente_ebitda",
    ]
    table = with_grand_total(selection.monthly(marts), ["dealer_name"], names)
    rows = with_leader(table, table.where(~F.col("is_total")))
    shown = derive(rows, ["fondo_top"]).select(
        "dealer_name", "is_total", *names, "es_top", "fondo_top"
    )
    return _by_sales(shown, "is_total")


def region_matrix(marts: Marts, selection: Selection = EVERYTHING) -> DataFrame:
    """Detail per region, through the dealers' dimension, with a grand total."""
    names = [
        "num_ventas", "ventas", "utilidad_bruta", "ebitda", "utilidad_neta", "margen_bruto",
        "margen_ebitda", "margen_neto", "cumplimiento", "brecha",
    ]
    table = with_grand_total(star_monthly(marts, selection), ["region"], names)
    return table.orderBy("is_total", F.desc_nulls_last("ventas"), "region")


def operations_cards(marts: Marts, selection: Selection = EVERYTHING) -> DataFrame:
    names = ["num_ventas", "ticket_promedio", "utilidad_bruta"]
    return evaluate(selection.monthly(marts), [], names)


def daily_trend(marts: Marts, selection: Selection = EVERYTHING) -> DataFrame:
    """Sales per day with the seven-day mean; days with neither are not shown.

    The month slicer applies after the mean, so the first days of a month
    still see the end of the month before.
    """
    fact = selection.with_months_before().daily(marts)
    trend = selection.days(moving_mean_7d(fact, marts.dim_fecha))
    shown = trend.where(F.col("ventas_media_7d").isNotNull())
    return shown.withColumnRenamed("ventas", "ventas_dia").orderBy("fecha")


def daily_detail(marts: Marts, selection: Selection = EVERYTHING) -> DataFrame:
    """Day by dealer with a grand total."""
    names = [
        "num_ventas_dia", "ventas_dia", "costo_dia", "utilidad_bruta_dia", "margen_bruto_dia",
    ]
    table = with_grand_total(selection.daily(marts), ["fecha", "dealer_name"], names)
    return table.orderBy("is_total", "fecha", "dealer_name")


def by_dealer_and_month(marts: Marts, selection: Selection = EVERYTHING) -> DataFrame:
    """Every monthly amount and ratio at the fact's own grain."""
    names = [
        "num_ventas", "ventas", "costo", "utilidad_bruta", "opex", "ebitda", "utilidad_neta",
        "objetivo_ventas", "margen_bruto", "margen_ebitda", "margen_neto", "ticket_promedio",
        "cumplimiento", "brecha", "pp_vs_objetivo",
    ]
    table = evaluate(selection.monthly(marts), ["dealer_name", "mes"], names)
    return table.orderBy("dealer_name", "mes")
