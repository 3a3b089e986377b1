"""Sales-to-net-income waterfall: nine steps from one row of totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The steps in order, with their kind.
TOTAL, DROP = "Total", "Baja"
STEPS = (
    ("Ventas", 1, TOTAL),
    ("Costo de ventas", 2, DROP),
    ("Utilidad bruta", 3, TOTAL),
    ("Gastos operativos", 4, DROP),
    ("EBITDA", 5, TOTAL),
    ("Depreciación", 6, DROP),
    ("Intereses", 7, DROP),
    ("Impuestos", 8, DROP),
    ("Utilidad neta", 9, TOTAL),
)
AXIS_MARGIN = 1.1

# Columns of the totals row that the steps read.
INPUTS = (
    "ventas",
    "costo",
    "utilidad_bruta",
    "opex",
    "ebitda",
    "depreciacion",
    "intereses",
    "impuestos",
    "utilidad_neta",
)


def _amount_and_level() -> dict[int, tuple[Column, Column]]:
    """Per step: the amount it takes away (if any) and the level after it."""
    none = F.lit(None).cast("double")
    v = {name: F.col(name).cast("double") for name in INPUTS}
    # exact on cents before the cast: a missing part counts as zero here
    zero = F.lit(0)
    depreciation = F.coalesce(F.col("depreciacion"), zero)
    interest = F.coalesce(F.col("intereses"), zero)
    after_depreciation = F.coalesce(F.col("ebitda"), zero) - depreciation
    any_depreciation = F.col("ebitda").isNotNull() | F.col("depreciacion").isNotNull()
    any_interest = any_depreciation | F.col("intereses").isNotNull()
    level_6 = F.when(any_depreciation, after_depreciation).cast("double")
    level_7 = F.when(any_interest, after_depreciation - interest).cast("double")
    return {
        1: (none, v["ventas"]),
        2: (v["costo"], v["utilidad_bruta"]),
        3: (none, v["utilidad_bruta"]),
        4: (v["opex"], v["ebitda"]),
        5: (none, v["ebitda"]),
        6: (v["depreciacion"], level_6),
        7: (v["intereses"], level_7),
        8: (v["impuestos"], v["utilidad_neta"]),
        9: (none, v["utilidad_neta"]),
    }


def waterfall(totals: DataFrame) -> DataFrame:
    """Nine rows per totals row: step, order, kind, amount and level after it.

    The steps are an array of literals exploded beside the totals, so the
    disconnected step table needs no join.
    """
    values = _amount_and_level()
    steps = F.array(
        *[
            F.struct(
                F.lit(name).alias("paso"),
                F.lit(order).alias("orden"),
                F.lit(kind).alias("tipo"),
                values[order][0].alias("monto_paso"),
                values[order][1].alias("nivel_paso"),
            )
            for name, order, kind in STEPS
        ]
    )
    keys = [c for c in totals.columns if c not in INPUTS]
    return totals.select(*keys, F.inline(steps))


def waterfall_columns(steps: DataFrame) -> DataFrame:
    """Stacked-column form: invisible base, visible drop, subtotal, axis maximum."""
    is_drop, is_total = F.col("tipo") == DROP, F.col("tipo") == TOTAL
    total = F.when(is_total, F.col("nivel_paso"))
    return steps.withColumns(
        {
            "cascada_base": F.when(is_drop, F.col("nivel_paso")),
            "cascada_baja": F.when(is_drop, F.col("monto_paso")),
            "cascada_total": total,
            "maximo_eje_cascada": total * F.lit(AXIS_MARGIN),
        }
    )
