"""The measure registry: additive sums at any grain, everything else on top.

A ratio is always rebuilt from summed amounts at the grain asked for; no
measure averages a ratio.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bands
from ..functions.money import blank_minus, safe_ratio
from ..operators.timeintel import change


@dataclass(frozen=True)
class Measure:
    """A named measure.

    ``source`` is the fact column an additive measure sums. A derived measure
    is ``build`` over the measures in ``uses``. With neither, an operator puts
    the column there (time shifts, the leader, the waterfall).
    """

    label: str
    alias: str
    source: str | None = None
    uses: tuple[str, ...] = ()
    build: Callable[..., Column] | None = None


# Display names of the measures; aliases are the result columns.
_ALL = (
    # monthly amounts
    Measure("Ventas", "ventas", "ventas"),
    Measure("Costo", "costo", "costo"),
    Measure("Utilidad Bruta", "utilidad_bruta", "utilidad_bruta"),
    Measure("Gastos Operativos", "opex", "opex"),
    Measure("EBITDA", "ebitda", "ebitda"),
    Measure("Utilidad Neta", "utilidad_neta", "utilidad_neta"),
    Measure("Num Ventas", "num_ventas", "num_ventas"),
    Measure("Objetivo Ventas", "objetivo_ventas", "objetivo_ventas"),
    # ratios and gaps
    Measure("Margen Bruto %", "margen_bruto", None, ("utilidad_bruta", "ventas"), safe_ratio),
    Measure("Margen EBITDA %", "margen_ebitda", None, ("ebitda", "ventas"), safe_ratio),
    Measure("Margen Neto %", "margen_neto", None, ("utilidad_neta", "ventas"), safe_ratio),
    Measure("Ticket Promedio", "ticket_promedio", None, ("ventas", "num_ventas"), safe_ratio),
    Measure("Cumplimiento %", "cumplimiento", None, ("ventas", "objetivo_ventas"), safe_ratio),
    Measure("Brecha vs Objetivo", "brecha", None, ("ventas", "objetivo_ventas"), blank_minus),
    Measure(
        "pp vs objetivo",
        "pp_vs_objetivo",
        None,
        ("cumplimiento",),
        lambda ratio: F.coalesce(ratio, F.lit(0.0)) - F.lit(1.0),
    ),
    # daily amounts
    Measure("Ventas Día", "ventas_dia", "ventas"),
    Measure("Costo Día", "costo_dia", "costo"),
    Measure("Utilidad Bruta Día", "utilidad_bruta_dia", "utilidad_bruta"),
    Measure("Num Ventas Día", "num_ventas_dia", "num_ventas"),
    Measure(
        "Margen Bruto Día %",
        "margen_bruto_dia",
        None,
        ("utilidad_bruta_dia", "ventas_dia"),
        safe_ratio,
    ),
    # time
    Measure("Ventas Mes Anterior", "ventas_mes_anterior"),
    Measure(
        "Ventas vs Mes Anterior %",
        "ventas_vs_mes_anterior",
        None,
        ("ventas", "ventas_mes_anterior"),
        change,
    ),
    Measure("Ventas Media Móvil 7d", "ventas_media_7d"),
    # waterfall
    Measure("Monto Paso", "monto_paso"),
    Measure("Nivel Paso", "nivel_paso"),
    Measure("Cascada Base", "cascada_base"),
    Measure("Cascada Baja", "cascada_baja"),
    Measure("Cascada Total", "cascada_total"),
    Measure("maximo eje cascada", "maximo_eje_cascada"),
    # ranking
    Measure("Ventas Máx Contexto", "ventas_max"),
    Measure("Es Top Ventas", "es_top"),
    # conditional formats
    Measure(
        "Color Cumplimiento", "color_cumplimiento", None, ("cumplimiento",), bands.attainment_band
    ),
    Measure(
        "Color Fuente Cumplimiento",
        "color_fuente_cumplimiento",
        None,
        ("cumplimiento",),
        bands.attainment_text,
    ),
    Measure("Color Signo EBITDA", "color_ebitda", None, ("margen_ebitda",), bands.sign_band),
    Measure(
        "Color Fuente Signo EBITDA", "color_fuente_ebitda", None, ("margen_ebitda",), bands.sign_text
    ),
    Measure("Color Margen Bruto", "color_margen_bruto", None, ("margen_bruto",), bands.sign_band),
    Measure("Color Margen Neto", "color_margen_neto", None, ("margen_neto",), bands.sign_band),
    Measure("Color Brecha Cumplimiento", "color_brecha", None, ("brecha",), bands.sign_band),
    Measure(
        "Color Ventas vs Mes Anterior",
        "color_vs_mes_anterior",
        None,
        ("ventas_vs_mes_anterior",),
        bands.sign_band,
    ),
    Measure("Color Signo pp vs objetivo", "color_pp", None, ("pp_vs_objetivo",), bands.sign_band),
    Measure("Color Barra Ventas", "color_barra", None, ("es_top",), bands.leader_bar),
    Measure("Fondo Top Ventas", "fondo_top", None, ("es_top",), bands.leader_background),
)

MEASURES: dict[str, Measure] = {m.alias: m for m in _ALL}
BY_LABEL: dict[str, str] = {m.label: m.alias for m in _ALL}

# Summed for the waterfall only; the model has no measure of their own for them.
PARTS = ("depreciacion", "intereses", "impuestos")


def _sum_source(name: str) -> str | None:
    return name if name in PARTS else MEASURES[name].source


def _needed(names: Iterable[str]) -> list[str]:
    """The measures to compute, inputs before what uses them."""
    order: list[str] = []
    for name in names:
        if name not in PARTS:
            for used in _needed(MEASURES[name].uses):
                if used not in order:
                    order.append(used)
        if name not in order:
            order.append(name)
    return order


def additive(names: Iterable[str]) -> list[Column]:
    """Sum columns that the named measures rest on."""
    wanted = [n for n in _needed(names) if _sum_source(n)]
    return [F.sum(_sum_source(n)).alias(n) for n in wanted]


def derive(rows: DataFrame, names: Iterable[str]) -> DataFrame:
    """Add derived measures to rows that already hold what they rest on."""
    for name in _needed(names):
        measure = MEASURES.get(name)
        if measure is not None and measure.build is not None and name not in rows.columns:
            rows = rows.withColumn(name, measure.build(*[F.col(u) for u in measure.uses]))
    return rows


def evaluate(fact: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Measures at the grain of ``by``: sum first, divide after."""
    rows = fact.groupBy(*by).agg(*additive(names))
    return derive(rows, names).select(*by, *names)


def with_grand_total(
    fact: DataFrame, by: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """Like ``evaluate`` plus one row for the whole, flagged ``is_total``."""
    keys = [F.col(c) for c in by]
    rows = fact.groupingSets([keys, []], *keys).agg(
        F.grouping(by[0]).cast("boolean").alias("is_total"), *additive(names)
    )
    return derive(rows, names).select(*by, "is_total", *names)
