"""One dealer, day and id may hold a large share of the rows: results stay whole."""

import datetime as dt
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saldero.operators.enrich import add_costs, with_position
from saldero.operators.quality import raw_report, repeated_keys
from saldero.plans import jobs, report
from saldero.plans.marts import Marts
from saldero.sources.lake import CURATED_SALES, RAW_SALES, read_layer

ROWS = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows: one dealer, one day, one id."""
    hot = F.col("id") % 3 == 0
    spread = F.col("id") % 40
    rows = spark.range(0, ROWS, 1, 6).select(
        F.when(hot, "same").otherwise(F.col("id").cast("string")).alias("car_id"),
        F.when(hot, F.lit(dt.date(2022, 3, 15)))
        .otherwise(F.date_add(F.lit(dt.date(2022, 2, 25)), spread.cast("int")))
        .alias("date"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("d"), spread)).alias("dealer_name"),
        F.lit("R").alias("dealer_region"),
        F.lit("Ford").alias("company"),
        F.lit("m").alias("model"),
        (F.lit(100.0) + F.col("id") % 977).alias("price"),
    )
    return rows


def test_sums_equal_brute_force(skewed):
    expected = defaultdict(Decimal)
    for row in skewed.collect():
        expected[(row.dealer_name, row.date.replace(day=1))] += Decimal(row.price)
    kpi = Marts.from_curated(add_costs(skewed)).kpi_mensual
    found = {(r.dealer_name, r.mes): r.ventas for r in kpi.collect()}
    assert found == expected


def test_repeated_hot_id_is_counted_exactly(skewed):
    counts = {r["date"]: r["n_repeated"] for r in repeated_keys(skewed, "date", "car_id").collect()}
    assert counts[dt.date(2022, 3, 15)] == ROWS // 3 - 1
    assert sum(counts.values()) == ROWS // 3 - 1


def test_hot_day_reaches_the_report_in_one_row(skewed):
    rows = raw_report(skewed).collect()
    assert sum(r.n_rows for r in rows) == ROWS


def test_positions_of_a_hot_day_have_no_gaps(skewed):
    placed = with_position(skewed, ["car_id", "price"])
    bounds = placed.groupBy("date").agg(
        F.min("position"), F.max("position"), F.countDistinct("position"), F.count("*")
    )
    for _, first, last, distinct, total in bounds.collect():
        assert first == 0 and last == total - 1 and distinct == total


def test_hot_day_survives_the_lake(spark, skewed, lake):
    unique = skewed.withColumn("car_id", F.monotonically_increasing_id().cast("string"))
    first, last = dt.date(2022, 2, 25), dt.date(2022, 4, 5)
    jobs.backfill(unique, first, last, lake)
    jobs.curate_range(spark, first, last, lake)
    for layer in (RAW_SALES, CURATED_SALES):
        assert read_layer(spark, lake.path(layer)).count() == ROWS


def test_moving_mean_equals_brute_force(skewed):
    model = Marts.from_curated(add_costs(skewed))
    sold = defaultdict(float)
    for row in skewed.collect():
        sold[row.date] += row.price
    for row in report.daily_trend(model).collect():
        window = [row.fecha - dt.timedelta(days=n) for n in range(7)]
        assert row.ventas_media_7d == pytest.approx(sum(sold.get(d, 0.0) for d in window) / 7)
