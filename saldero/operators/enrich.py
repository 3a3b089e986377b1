"""Reproducible cost, expense and target columns.

Every random share is a hash of a business key computed in place, so the
enrichment of a fact needs no lookup table, no join and no shuffle, and a day
enriched alone equals the same day inside a full load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..functions.keyed import keyed_uniform
from ..functions.money import AMOUNT, PRICE, row_sum, to_cents
from ..session import ensure_checkpoint_dir

# Rates and ranges of the simulated figures.
TAX_RATE = 0.30
MARGIN_RANGE = (0.08, 0.20)
NOISE_RANGE = (-0.01, 0.01)
TARGET_RANGE = (0.90, 1.15)
EXPENSE_RANGES = {
    "nomina": (0.030, 0.045),
    "renta": (0.010, 0.020),
    "marketing": (0.005, 0.015),
    "otros_gastos": (0.005, 0.012),
    "depreciacion": (0.003, 0.006),
    "intereses": (0.002, 0.008),
}
OPEX_COLUMNS = ("nomina", "renta", "marketing", "otros_gastos")
EXPENSE_COLUMNS = (*EXPENSE_RANGES, "impuestos")
MONTH_KEY = ("dealer_name", "mes")
# What the curated layer adds to a sale.
COST_TYPES = {"costo": "double", "utilidad_bruta": "double", "mes": "date"}


def model_margin() -> Column:
    """Gross-margin share, constant per (company, model)."""
    return keyed_uniform(*MARGIN_RANGE, "margen", "company", "model")


def add_costs(sales: DataFrame, noise_key: str = "car_id") -> DataFrame:
    """Add ``costo``, ``utilidad_bruta`` and ``mes`` to each sale.

    The per-sale noise is keyed by ``car_id``. A frame without it needs another
    column that identifies the sale (see ``with_position``).
    """
    if noise_key not in sales.columns:
        raise ValueError(f"no column {noise_key!r} to key the noise of each sale")
    noise = keyed_uniform(*NOISE_RANGE, "ruido", noise_key)
    price = F.col("price").cast("double")
    return (
        sales.withColumn("costo", to_cents(price * (F.lit(1.0) - (model_margin() + noise))))
        .withColumn("utilidad_bruta", to_cents(price - F.col("costo")))
        .withColumn("mes", month_start(F.col("date")))
    )


def with_position(
    sales: DataFrame, order_by: Sequence[str], name: str = "position", folder: str | None = None
) -> DataFrame:
    """Number the sales of each day from zero in the order of ``order_by``.

    For sources without ``car_id``: the position then serves as the noise key.
    Rows are range-partitioned and numbered where they are, so a day may spread
    over many tasks; equal rows, which are interchangeable, are told apart by
    their place in the source, so that they spread as well. Only the row count
    of each (partition, day) is summed up. The sorted rows are stored, because
    both the counts and the numbers must come from one partitioning: in
    ``folder``, which is the caller's to remove, or else as a checkpoint.
    """
    spark = sales.sparkSession
    serial = F.monotonically_increasing_id()
    ranked = (
        sales.withColumn("_place", F.xxhash64(serial))
        .repartitionByRange("date", *order_by, "_place")
        .sortWithinPartitions("date", *order_by, "_place")
        .withColumn("_serial", serial)
        .withColumn("_part", F.spark_partition_id())
    )
    if folder is None:
        ensure_checkpoint_dir(spark)
        ranked = ranked.checkpoint()
    else:
        ranked.write.parquet(f"{folder}/rows")
        ranked = spark.read.schema(ranked.schema).parquet(f"{folder}/rows")
    runs = ranked.groupBy("date", "_part").agg(
        F.min("_serial").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    earlier = W.partitionBy("date").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = runs.select(
        F.col("date").alias("_date"),
        F.col("_part").alias("_run"),
        "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    same_run = (F.col("_run") == F.col("_part")) & F.col("_date").eqNullSafe(F.col("date"))
    placed = ranked.join(starts, same_run).withColumn(
        name, F.col("_serial") - F.col("_first") + F.col("_before")
    )
    return placed.select(*sales.columns, name)


def monthly_base(curated: DataFrame) -> DataFrame:
    """Exact sales and gross profit per dealer and month; keyless rows left out."""
    keyed = curated.where(F.col("dealer_name").isNotNull() & F.col("mes").isNotNull())
    return keyed.groupBy(*MONTH_KEY).agg(
        F.coalesce(F.sum(F.col("price").cast(PRICE)), F.lit(0)).cast("double").alias("ventas"),
        F.coalesce(F.sum(F.col("utilidad_bruta").cast(AMOUNT)), F.lit(0))
        .cast("double")
        .alias("utilidad_bruta"),
    )


def _share(name: str, bounds: tuple[float, float]) -> Column:
    return keyed_uniform(*bounds, name, "dealer_name", "date_format(mes, 'yyyy-MM')")


def with_expenses(base: DataFrame) -> DataFrame:
    """Six expense lines and the tax line beside each month's sales."""
    lined = base.withColumns(
        {
            name: to_cents(F.col("ventas") * _share(name, bounds))
            for name, bounds in EXPENSE_RANGES.items()
        }
    )
    before_tax = (
        F.col("utilidad_bruta")
        - row_sum(*[F.col(c) for c in OPEX_COLUMNS])
        - F.col("depreciacion")
        - F.col("intereses")
    )
    taxed = F.greatest(before_tax, F.lit(0.0)) * F.lit(TAX_RATE)
    return lined.withColumn("impuestos", to_cents(taxed))


def with_target(base: DataFrame) -> DataFrame:
    share = _share("objetivo", TARGET_RANGE)
    return base.withColumn("objetivo_ventas", to_cents(F.col("ventas") * share))


def monthly_expenses(base: DataFrame) -> DataFrame:
    return with_expenses(base).select(*MONTH_KEY, *EXPENSE_COLUMNS)


def monthly_targets(base: DataFrame) -> DataFrame:
    return with_target(base).select(*MONTH_KEY, "objetivo_ventas")
