"""Sales facts built from the order tables.

Two bindings: orders (dealer = the customer's nation) and, four times as many
rows and far more dealers, line items (dealer = the supplier). No join is
hinted: dimension sizes are left to the planner's own size checks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saldero.operators.enrich import add_costs, monthly_base, monthly_expenses, monthly_targets
from saldero.plans.marts import Marts, typed_sales
from saldero.plans.report import Selection
from saldero.sources.sales import prepare_sales


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )


def orders_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    places = _places(spark, sf_dir)
    return orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        places, customer.c_nationkey == places.n_nationkey
    )


def source_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source as delivered: raw headers, personal data included."""
    return orders_with_customer(spark, sf_dir).select(
        F.col("o_orderkey").alias("Car_id"),
        F.to_date("o_orderdate").alias("Date"),
        F.col("c_name").alias("Customer Name"),
        F.col("c_acctbal").alias("Annual Income"),
        F.col("n_name").alias("Dealer_Name"),
        F.col("r_name").alias("Dealer_Region"),
        F.col("c_mktsegment").alias("Company"),
        F.col("o_orderpriority").alias("Model"),
        F.col("o_totalprice").alias("Price ($)"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_sales(source_sales(spark, sf_dir))


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_costs(sales(spark, sf_dir))


def ventas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_sales(curated(spark, sf_dir))


def monthly_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    base = monthly_base(curated(spark, sf_dir))
    return monthly_expenses(base), monthly_targets(base)


def marts(spark: SparkSession, sf_dir: str) -> Marts:
    return Marts.from_curated(curated(spark, sf_dir))


def line_sales(spark: SparkSession, sf_dir: str, price: Column | None = None) -> DataFrame:
    """Line items as sales: the supplier sells, the part names the model."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    supplier, places = table(spark, sf_dir, "supplier"), _places(spark, sf_dir)
    return (
        line.join(part, line.l_partkey == part.p_partkey)
        .join(supplier, line.l_suppkey == supplier.s_suppkey)
        .join(places, supplier.s_nationkey == places.n_nationkey)
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("car_id"),
            F.to_date("l_shipdate").alias("date"),
            F.col("s_name").alias("dealer_name"),
            F.col("r_name").alias("dealer_region"),
            F.col("p_brand").alias("company"),
            F.col("p_type").alias("model"),
            (F.col("l_extendedprice") if price is None else price).alias("price"),
        )
    )


def wide_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items at prices far over a billion, with eighths."""
    whole = F.floor(F.col("l_extendedprice") * 100) * F.lit(1000.0)
    return line_sales(spark, sf_dir, whole + F.col("l_quantity") / 8)


def line_marts(spark: SparkSession, sf_dir: str) -> Marts:
    return Marts.from_curated(add_costs(line_sales(spark, sf_dir)))


# Faults are chosen by attributes of the order, over the whole table.
URGENT, HIGH, MEDIUM, LOW = "1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"
FIRST_BAD_YEAR = 2000
TIGHT_MAX_PRICE = 450_000


def faulty_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales that break every raw rule somewhere."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    segment = F.col("c_mktsegment")
    return orders_with_customer(spark, sf_dir).select(
        F.col("n_name").alias("car_id"),
        F.to_date("o_orderdate").alias("date"),
        F.when((segment == "BUILDING") & (priority == HIGH), F.lit("   "))
        .otherwise(F.col("n_name"))
        .alias("dealer_name"),
        F.when(~((status == "O") & (priority == MEDIUM)), segment).alias("company"),
        F.when((status == "F") & (priority == LOW), F.lit("\t"))
        .otherwise(priority)
        .alias("model"),
        F.when((status == "P") & (priority == LOW), F.lit(None).cast("double"))
        .when((status == "F") & (priority == URGENT), -F.col("o_totalprice"))
        .otherwise(F.col("o_totalprice"))
        .alias("price"),
    )


def late_fault_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales whose first bad price comes in a late year."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    bad = (
        (F.year("o_orderdate") >= FIRST_BAD_YEAR) & (status == "P") & (priority == URGENT)
    )
    joined = orders_with_customer(spark, sf_dir)
    return prepare_sales(
        joined.select(
            F.col("o_orderkey").alias("car_id"),
            F.to_date("o_orderdate").alias("date"),
            F.col("n_name").alias("dealer_name"),
            F.col("r_name").alias("dealer_region"),
            F.col("c_mktsegment").alias("company"),
            F.col("o_orderpriority").alias("model"),
            F.when(bad, F.lit(-1.0)).otherwise(F.col("o_totalprice")).alias("price"),
        )
    )


def faulty_curated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Curated sales that break every curated rule, and the raw sales."""
    raw = sales(spark, sf_dir)
    good = add_costs(raw).where(F.col("company") != "HOUSEHOLD")
    segment, model = F.col("company"), F.col("model")
    cost = (
        F.when((segment == "BUILDING") & (model == LOW), F.col("price") + F.lit(1.0))
        .when((segment == "BUILDING") & (model == HIGH), F.col("price") * F.lit(0.5))
        .when((segment == "MACHINERY") & (model == LOW), F.lit(None).cast("double"))
        .otherwise(F.col("costo"))
    )
    profit = (
        F.when((segment == "FURNITURE") & (model == URGENT), F.col("utilidad_bruta") + F.lit(50.0))
        .when((segment == "BUILDING") & (model == HIGH), F.col("price") * F.lit(0.5))
        .when((segment == "MACHINERY") & (model == HIGH), F.lit(None).cast("double"))
        .otherwise(F.col("utilidad_bruta"))
    )
    return (
        good.withColumn("costo_", cost)
        .withColumn("utilidad_bruta", profit)
        .withColumn("costo", F.col("costo_"))
        .drop("costo_"),
        raw,
    )


def faulty_monthly(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Monthly tables with repeated, negative, missing, zero and absent entries."""
    expenses, targets = monthly_tables(spark, sf_dir)
    number = F.month("mes")
    bad = expenses.withColumns(
        {
            "renta": F.when(number == 6, F.lit(-1.0)).otherwise(F.col("renta")),
            "nomina": F.when(number != 7, F.col("nomina")),
        }
    )
    repeated = bad.unionByName(bad.where(number == 1))
    zeroed = targets.withColumn(
        "objetivo_ventas", F.when(number == 8, F.lit(0.0)).otherwise(F.col("objetivo_ventas"))
    )
    return repeated, zeroed.where(number != 9)


# Slicer values used by the filtered report queries.
SLICE = Selection(
    months=tuple(dt.date(1996, m, 1) for m in range(1, 7)),
    regions=("ASIA", "EUROPE"),
)
DEALER_SLICE = Selection(
    months=(dt.date(1998, 3, 1), dt.date(1998, 5, 1)),
    dealers=tuple(f"NATION_{n}" for n in (1, 3, 7, 12, 18)),
)
# The first day whose sales carry a region.
DRIFT = dt.date(1998, 6, 13)
# Months that the merged marts see change, lose all sales, and arrive late.
CHANGED, LOST, LATE = dt.date(1996, 2, 1), dt.date(1997, 7, 1), dt.date(1998, 5, 1)
# Forms in which the dates of a load may be written; the last ones are no plain formats.
DATE_FORMATS = (
    "yyyy-MM-dd", "M/d/yyyy", "yyyy/M/d", "d/M/yyyy", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy H:mm",
    "M/d/yyyy H:mm:ss", "yyyyMMdd", "yyyy-MM-dd'T'HH:mm:ss", "M/d/yy", "d MMM yyyy", "MMM d, yyyy",
)
DATE_SHAPES = (
    "MMMM d, yyyy", "d MMMM yyyy", "d.M.yyyy", "yyyy.MM.dd", "dd-MM-yy", "d-MMM-yy",
    "EEE, d MMM yyyy", "EEEE, MMMM d, yyyy", "M-d-yyyy h:mm a", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'",
    "yyyy-MM-dd'T'HH:mm:ss'+02:00'", "dd.MM.yyyy HH:mm:ss '-0500'",
)
