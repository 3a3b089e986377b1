"""Typed tables, star schema and monthly/daily facts as lazy frames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import calendar_attributes, month_label, month_start
from ..functions.money import AMOUNT, PRICE, safe_ratio
from ..operators.enrich import EXPENSE_COLUMNS, MONTH_KEY, OPEX_COLUMNS, with_expenses, with_target

KPI_MONTHLY_COLUMNS = (
    "dealer_name", "mes", "num_ventas", "ventas", "costo", "utilidad_bruta", "opex", "ebitda",
    "depreciacion", "intereses", "impuestos", "utilidad_neta", "objetivo_ventas",
    "ticket_promedio", "margen_bruto", "margen_ebitda", "cumplimiento",
)

SUMS = ("num_ventas", "ventas", "costo", "utilidad_bruta")
DAY_KEY = ("fecha", "mes", "dealer_name")


def typed_sales(curated: DataFrame) -> DataFrame:
    return curated.select(
        F.col("car_id").cast("string").alias("car_id"),
        F.col("date").cast("date").alias("fecha"),
        F.col("mes").cast("date").alias("mes"),
        "dealer_name",
        "dealer_region",
        "company",
        "model",
        F.col("price").cast(PRICE).alias("precio"),
        F.col("costo").cast(AMOUNT).alias("costo"),
        F.col("utilidad_bruta").cast(AMOUNT).alias("utilidad_bruta"),
    )


def _typed_monthly(table: DataFrame, amounts: tuple[str, ...]) -> DataFrame:
    return table.select(
        "dealer_name",
        F.col("mes").cast("date").alias("mes"),
        *[F.col(a).cast(AMOUNT).alias(a) for a in amounts],
    )


def typed_expenses(expenses: DataFrame) -> DataFrame:
    return _typed_monthly(expenses, EXPENSE_COLUMNS)


def typed_targets(targets: DataFrame) -> DataFrame:
    return _typed_monthly(targets, ("objetivo_ventas",))


def dim_dealer(sold: DataFrame, region: str = "dealer_region") -> DataFrame:
    """One region per dealer; the smallest, so that every run answers the same.

    The sales are hashed down to pairs first: the minimum of a text has no hash
    aggregate and would sort them all. A dealer has no more regions than there are.
    """
    pairs = sold.select("dealer_name", F.col(region).alias("region")).distinct()
    smallest = F.array_min(F.collect_set("region"))
    return pairs.groupBy("dealer_name").agg(smallest.alias("region"))


def dim_date(sold: DataFrame, first: str = "fecha", last: str = "fecha") -> DataFrame:
    """Every day between the first and the last sale."""
    bounds = sold.agg(F.min(first).alias("first"), F.max(last).alias("last"))
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("fecha"))
    day = F.col("fecha")
    return days.select(
        "fecha",
        month_start(day).alias("mes"),
        F.year(day).cast("bigint").alias("anio"),
        F.month(day).cast("bigint").alias("mes_numero"),
        month_label(day).alias("anio_mes"),
    )


def dim_month(calendar: DataFrame) -> DataFrame:
    return calendar.select("mes").distinct()


def report_calendar(calendar: DataFrame) -> DataFrame:
    """Whole calendar years around the model's days, with display attributes."""
    bounds = calendar.agg(
        F.make_date(F.year(F.min("fecha")), F.lit(1), F.lit(1)).alias("first"),
        F.make_date(F.year(F.max("fecha")), F.lit(12), F.lit(31)).alias("last"),
    )
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("date"))
    return days.select("date", *calendar_attributes(F.col("date")))


def _amount_sums() -> list:
    return [
        F.count(F.lit(1)).alias("num_ventas"),
        F.sum("precio").alias("ventas"),
        F.sum("costo").alias("costo"),
        F.sum("utilidad_bruta").alias("utilidad_bruta"),
    ]


def kpi_daily(ventas: DataFrame) -> DataFrame:
    """Daily fact. ``mes`` follows from ``fecha``, so it does not change the grain;
    as a grouping key it lets a month filter reach the partitions of the sales."""
    return ventas.groupBy(*DAY_KEY).agg(*_amount_sums())


def sales_by_region(ventas: DataFrame) -> DataFrame:
    """Sums per day, dealer and region: one pass over the sales that all marts follow from."""
    return ventas.groupBy(*DAY_KEY, F.col("dealer_region").alias("region")).agg(*_amount_sums())


def regions_to_days(by_region: DataFrame) -> DataFrame:
    """The daily fact from ``sales_by_region``; the sums are exact."""
    return by_region.groupBy(*DAY_KEY).agg(*[F.sum(n).alias(n) for n in SUMS])


def dealer_months(by_region: DataFrame) -> DataFrame:
    """Per month, dealer and region the first and last day: what both dimensions are made of."""
    bounds = [F.min("fecha").alias("primera"), F.max("fecha").alias("ultima")]
    return by_region.groupBy("mes", "dealer_name", "region").agg(*bounds)


def sales_by_month(ventas: DataFrame) -> DataFrame:
    return ventas.groupBy(*MONTH_KEY).agg(*_amount_sums())


def days_by_month(daily: DataFrame) -> DataFrame:
    """The sums of ``sales_by_month`` from those of the daily fact; they are exact."""
    return daily.groupBy(*MONTH_KEY).agg(*[F.sum(n).alias(n) for n in SUMS])


def _with_results(base: DataFrame) -> DataFrame:
    """Results and ratios of a month row that carries its expenses and target."""
    opex = F.col(OPEX_COLUMNS[0])
    for name in OPEX_COLUMNS[1:]:
        opex = opex + F.col(name)
    profit, sales = F.col("utilidad_bruta"), F.col("ventas")
    return (
        base.withColumn("opex", opex)
        .withColumn("ebitda", profit - F.col("opex"))
        .withColumn(
            "utilidad_neta",
            F.col("ebitda") - F.col("depreciacion") - F.col("intereses") - F.col("impuestos"),
        )
        .withColumns(
            {
                "ticket_promedio": safe_ratio(sales, F.col("num_ventas")),
                "margen_bruto": safe_ratio(profit, sales),
                "margen_ebitda": safe_ratio(F.col("ebitda"), sales),
                "cumplimiento": safe_ratio(sales, F.col("objetivo_ventas")),
            }
        )
        .select(*KPI_MONTHLY_COLUMNS)
    )


def kpi_monthly(ventas: DataFrame, gastos: DataFrame, objetivos: DataFrame) -> DataFrame:
    """Monthly fact over the stored tables.

    Sales are aggregated before they meet the tables that have one row per
    dealer and month, so no join sees the sale grain.
    """
    return _joined_results(sales_by_month(ventas), gastos, objetivos)


def _joined_results(sums: DataFrame, gastos: DataFrame, objetivos: DataFrame) -> DataFrame:
    base = sums.join(gastos, [*MONTH_KEY], "left")
    return _with_results(base.join(objetivos, [*MONTH_KEY], "left"))


def kpi_monthly_from_sales(ventas: DataFrame) -> DataFrame:
    """Monthly fact straight from typed sales: one shuffle and no join."""
    return derived_results(sales_by_month(ventas))


def derived_results(sums: DataFrame) -> DataFrame:
    """Results of a month with the expenses and targets that follow from its sums.

    They are computed beside the sums instead of being stored and joined back.
    Rows without a dealer or month get none, as in the stored tables.
    """
    zero = F.lit(0)
    basis = sums.select(
        *MONTH_KEY,
        F.coalesce("ventas", zero).cast("double").alias("ventas"),
        F.coalesce("utilidad_bruta", zero).cast("double").alias("utilidad_bruta"),
        F.struct(*[F.col(c) for c in sums.columns if c not in MONTH_KEY]).alias("exact"),
    )
    lined = with_target(with_expenses(basis))
    keyed = F.col("dealer_name").isNotNull() & F.col("mes").isNotNull()
    return _with_results(
        lined.select(
            *MONTH_KEY,
            "exact.*",
            *[
                F.when(keyed, F.col(c).cast(AMOUNT)).alias(c)
                for c in (*EXPENSE_COLUMNS, "objetivo_ventas")
            ],
        )
    )


@dataclass(frozen=True)
class Marts:
    """The star schema: two facts and three dimensions.

    ``kpi_diario`` carries ``mes`` beside its public columns. ``results`` makes
    the monthly fact from the sums of each dealer and month, ``by_region`` are
    the sums that all of them can be made from. ``source`` tells what stored
    partitions the marts were made of, if it is known.
    """

    kpi_mensual: DataFrame
    kpi_diario: DataFrame
    dim_concesionaria: DataFrame
    dim_fecha: DataFrame
    dim_mes: DataFrame
    results: Callable[[DataFrame], DataFrame]
    by_region: DataFrame | None = None
    source: dict | None = None

    @classmethod
    def of(cls, ventas: DataFrame, results: Callable[[DataFrame], DataFrame]) -> Marts:
        calendar = dim_date(ventas)
        return cls(
            kpi_mensual=results(sales_by_month(ventas)),
            kpi_diario=kpi_daily(ventas),
            dim_concesionaria=dim_dealer(ventas),
            dim_fecha=calendar,
            dim_mes=dim_month(calendar),
            results=results,
            by_region=sales_by_region(ventas),
        )

    @classmethod
    def from_tables(cls, ventas: DataFrame, gastos: DataFrame, objetivos: DataFrame) -> Marts:
        return cls.of(ventas, lambda sums: _joined_results(sums, gastos, objetivos))

    @classmethod
    def from_curated(cls, curated: DataFrame) -> Marts:
        return cls.of(typed_sales(curated), derived_results)

    def over(self, daily: DataFrame, months: DataFrame) -> Marts:
        """The same marts from a stored daily fact and ``dealer_months``, without the sales."""
        calendar = dim_date(months, "primera", "ultima")
        return replace(
            self,
            kpi_mensual=self.results(days_by_month(daily)),
            kpi_diario=daily,
            dim_concesionaria=dim_dealer(months, "region"),
            dim_fecha=calendar,
            dim_mes=dim_month(calendar),
            by_region=None,
        )

    def views(self) -> dict[str, DataFrame]:
        return {
            "dim_concesionaria": self.dim_concesionaria,
            "dim_fecha": self.dim_fecha,
            "kpi_diario": self.kpi_diario.drop("mes"),
            "kpi_mensual": self.kpi_mensual,
        }
