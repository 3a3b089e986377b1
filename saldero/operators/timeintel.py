"""Calendar-aware measures without row-number windows.

Both operators let a value contribute to every date it is visible from and
aggregate again. That is exact over gaps, needs no ordering and no window
whose partition could end in one task, and its input is already aggregated.
With keys, rows are first placed by key: a key has at most one row per date of
the calendar, and the repeated rows are then summed where they are made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import previous_month
from ..functions.money import blank_minus, safe_ratio

# Fixed value: length and divisor of the moving mean, in calendar days.
WINDOW_DAYS = 7


def _placed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.repartition(*keys) if keys else rows


def moving_mean_7d(
    daily: DataFrame, calendar: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Sales of the day and mean over the seven calendar days ending there.

    ``daily`` carries ``fecha`` and ``ventas`` (any finer grain is summed),
    ``calendar`` every day of the model. The divisor is always seven; a window
    without sales is null. Without keys the result has every calendar day; with
    keys it has the days on which a key has a value to show.
    """
    per_day = _placed(daily.groupBy(*keys, "fecha").agg(F.sum("ventas").alias("ventas")), keys)
    reach = F.sequence(F.col("fecha"), F.date_add(F.col("fecha"), WINDOW_DAYS - 1))
    spread = per_day.select(*keys, "ventas", F.posexplode(reach).alias("age", "day"))
    shown = spread.groupBy(*keys, F.col("day").alias("fecha")).agg(
        F.sum(F.when(F.col("age") == 0, F.col("ventas"))).alias("ventas"),
        F.sum("ventas").alias("in_window"),
    )
    days = calendar.select("fecha")
    placed = shown.join(days, "fecha", "inner") if keys else days.join(shown, "fecha", "left")
    return placed.select(
        *keys,
        "fecha",
        "ventas",
        (F.col("in_window").cast("double") / F.lit(float(WINDOW_DAYS))).alias("ventas_media_7d"),
    )


def with_previous_month(
    monthly: DataFrame, months: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Sales per month beside those of the previous calendar month.

    A month without sales still shows when the month before it had some, and a
    gap never borrows from an older month. ``months`` bounds the result to the
    months of the model.
    """
    per_month = _placed(monthly.groupBy(*keys, "mes").agg(F.sum("ventas").alias("ventas")), keys)
    spread = per_month.select(
        *keys,
        F.inline(
            F.array(
                F.struct(
                    F.col("mes"),
                    F.col("ventas"),
                    F.lit(None).cast(per_month.schema["ventas"].dataType).alias("anterior"),
                ),
                F.struct(
                    F.add_months("mes", 1).alias("mes"),
                    F.lit(None).cast(per_month.schema["ventas"].dataType).alias("ventas"),
                    F.col("ventas").alias("anterior"),
                ),
            )
        ),
    )
    shown = spread.groupBy(*keys, "mes").agg(
        F.sum("ventas").alias("ventas"), F.sum("anterior").alias("ventas_mes_anterior")
    )
    return shown.join(months.select("mes"), "mes", "left_semi").select(
        *keys,
        "mes",
        "ventas",
        "ventas_mes_anterior",
        change(F.col("ventas"), F.col("ventas_mes_anterior")).alias("ventas_vs_mes_anterior"),
    )


def change(current: Column, previous: Column) -> Column:
    """Relative change; null when the previous value is missing or zero."""
    return safe_ratio(blank_minus(current, previous), previous)


def month_before_latest(months: DataFrame) -> Column:
    """Scalar: the calendar month before the latest of the selected months."""
    return months.agg(previous_month(F.max("mes")).alias("mes")).scalar()
