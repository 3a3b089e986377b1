"""The visuals of a page from one pass over the monthly fact.

A page shows totals, trends by month and rankings by dealer under one selection.
Each visual alone reads and sums the fact again. Here the fact is read once, with
the filters that all visuals share, into grouping sets: one level for the whole,
one by month and one by dealer, each apart for months inside and outside of the
month slicer. The levels are small, are stored once, and every visual is the rest
of its query over its own level.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import top_n, with_leader
from ..operators.timeintel import month_before_latest
from ..session import scratch_path
from .marts import Marts
from .metrics import additive, derive
from .report import EVERYTHING, Selection

# What the visuals of the page rest on.
_AMOUNTS = ("ventas", "utilidad_bruta", "ebitda", "utilidad_neta", "objetivo_ventas")


@dataclass(frozen=True)
class Levels:
    """Sums of the fact: ``level`` names the grain, ``chosen`` the months of the slicer."""

    rows: DataFrame
    marts: Marts
    selection: Selection

    def _sums(self, level: str, keys: Sequence[str], where: Column | None = None) -> DataFrame:
        found = self.rows.where(F.col("level") == level)
        if where is not None:
            found = found.where(where)
        # at most two rows per key: months inside and outside of the slicer
        return found.groupBy(*keys).agg(*[F.sum(a).alias(a) for a in _AMOUNTS])

    def whole(self) -> DataFrame:
        return self._sums("whole", [], F.col("chosen"))

    def dealers(self) -> DataFrame:
        return self._sums("dealer", ["dealer_name"], F.col("chosen"))

    def months(self) -> DataFrame:
        """All months, those outside of the slicer too."""
        return self._sums("month", ["mes"])


def levels(marts: Marts, selection: Selection = EVERYTHING) -> Levels:
    """One aggregate over one scan of the monthly fact, stored for the visuals of a page."""
    fact = selection.all_months().monthly(marts)
    inside = F.lit(True) if selection.months is None else F.col("mes").isin(list(selection.months))
    flagged = fact.withColumn("chosen", inside)
    sets = [
        [F.col("chosen")],
        [F.col("chosen"), F.col("mes")],
        [F.col("chosen"), F.col("dealer_name")],
    ]
    level = (
        F.when(F.grouping("mes") == 0, F.lit("month"))
        .when(F.grouping("dealer_name") == 0, F.lit("dealer"))
        .otherwise(F.lit("whole"))
    )
    keys = [F.col(c) for c in ("chosen", "mes", "dealer_name")]
    summed = flagged.groupingSets(sets, *keys).agg(level.alias("level"), *additive(_AMOUNTS))
    spark = fact.sparkSession
    path = f"{scratch_path(spark, 'page')}/levels"
    summed.write.parquet(path)
    return Levels(spark.read.schema(summed.schema).parquet(path), marts, selection)


def headline_cards(found: Levels) -> DataFrame:
    names = ["ventas", "utilidad_bruta", "ebitda", "utilidad_neta", "cumplimiento"]
    return derive(found.whole(), [*names, "color_cumplimiento"]).select(*names, "color_cumplimiento")


def secondary_cards(found: Levels) -> DataFrame:
    """The month before the latest one in context is looked up among all months."""
    before = month_before_latest(found.selection.model_months(found.marts))
    months = found.months().withColumn("_before", before)
    previous = months.where(F.col("mes") == F.col("_before")).agg(
        F.sum("ventas").alias("ventas_mes_anterior")
    )
    names = [
        "ventas_vs_mes_anterior", "margen_bruto", "margen_ebitda", "margen_neto", "brecha",
        "pp_vs_objetivo", "color_vs_mes_anterior", "color_margen_bruto", "color_ebitda",
        "color_margen_neto", "color_brecha", "color_pp",
    ]
    totals = found.whole().withColumn("ventas_mes_anterior", previous.scalar())
    return derive(totals, names).select("ventas_mes_anterior", *names)


def _trend(found: Levels, names: Sequence[str]) -> DataFrame:
    return derive(found.months(), names).select("mes", *names).orderBy("mes")


def sales_against_target(found: Levels) -> DataFrame:
    return _trend(found, ["ventas", "objetivo_ventas", "cumplimiento"])


def margin_trend(found: Levels) -> DataFrame:
    return _trend(found, ["margen_bruto", "margen_ebitda"])


def dealer_ranking(found: Levels) -> DataFrame:
    dealers = found.dealers().select("dealer_name", "ventas")
    shown = derive(with_leader(top_n(dealers), dealers), ["color_barra"])
    columns = shown.select("dealer_name", "ventas", "ventas_max", "es_top", "color_barra")
    return columns.orderBy(F.desc_nulls_last("ventas"), "dealer_name")


def dealer_matrix(found: Levels) -> DataFrame:
    names = [
        "ventas", "utilidad_bruta", "ebitda", "margen_ebitda", "cumplimiento", "utilidad_neta",
        "color_cumplimiento", "color_fuente_cumplimiento", "color_ebitda", "color_fuente_ebitda",
    ]
    dealers = found.dealers().withColumn("is_total", F.lit(False))
    # nothing selected has no total
    total = found._sums("whole", ["chosen"], F.col("chosen")).drop("chosen")
    total = total.withColumns({"is_total": F.lit(True), "dealer_name": F.lit(None).cast("string")})
    table = derive(dealers.unionByName(total), names).select("dealer_name", "is_total", *names)
    rows = with_leader(table, table.where(~F.col("is_total")))
    shown = derive(rows, ["fondo_top"]).select(
        "dealer_name", "is_total", *names, "es_top", "fondo_top"
    )
    return shown.orderBy("is_total", F.desc_nulls_last("ventas"), "dealer_name")


VISUALS = {
    "R1": headline_cards,
    "R2": secondary_cards,
    "R3": sales_against_target,
    "R4": margin_trend,
    "R6": dealer_ranking,
    "R8": dealer_matrix,
}


def page(marts: Marts, selection: Selection = EVERYTHING) -> dict[str, DataFrame]:
    """Every visual of the page under one selection, from one scan of the fact."""
    found = levels(marts, selection)
    return {name: build(found) for name, build in VISUALS.items()}
