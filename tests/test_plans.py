"""Plan shapes that must hold whatever the data size."""

import datetime as dt
import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from saldero.operators.enrich import add_costs
from saldero.operators.timeintel import moving_mean_7d, with_previous_month
from saldero.plans import jobs, marts, report, warehouse
from saldero.sources.lake import RAW_SALES, Lake, write_partitions
from testbed import tables as t
from testbed.queries import all_queries

LAKE_QUERIES = {
    "S1_csv_ingest", "S8_backfill_counts", "I3_lake_roundtrip", "S17_stored_marts",
    "I5_idempotent", "I2_month_rebuild", "I6_month_refresh", "I7_partial_failure",
    "I4_daily_run", "E9_position_key", "I6_mart_merge", "S17_snapshot_reads", "S14_clustered",
    "I5_fingerprints", "Q10_swapped_rows",
}


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(pattern: str, df) -> int:
    return len(re.findall(pattern, physical(df)))


@pytest.mark.parametrize("name", sorted(set(all_queries()) - LAKE_QUERIES))
def test_no_python_no_window_no_cross_join(spark, name):
    plan = physical(all_queries()[name](spark, SMALL))
    assert not re.search(r"Python|Pandas|ArrowEval", plan)
    assert "Window" not in plan
    assert not re.search(r"CartesianProduct|NestedLoopJoin", plan)


def test_monthly_fact_needs_one_shuffle(spark):
    kpi = t.marts(spark, SMALL).kpi_mensual
    assert count(r"Exchange hashpartitioning", kpi) == 1
    assert count(r"HashAggregate\(", kpi) == 2


def test_enrichment_needs_no_shuffle(spark):
    assert "Exchange hashpartitioning" not in physical(add_costs(t.sales(spark, SMALL)))


def test_keyed_time_operators_place_rows_before_repeating_them(spark):
    model = t.marts(spark, SMALL)
    mean = moving_mean_7d(model.kpi_diario, model.dim_fecha, ["dealer_name"])
    change = with_previous_month(model.kpi_mensual, model.dim_mes, ["dealer_name"])
    for rows, key in ((mean, "fecha"), (change, "mes")):
        plan = physical(rows)
        generate = plan.index("Generate")
        above = plan[:generate]
        assert "hashpartitioning(dealer_name" not in above, key


def test_only_needed_columns_are_read(spark):
    plan = physical(t.marts(spark, SMALL).kpi_mensual)
    schemas = " ".join(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    for unused in ("o_orderstatus", "c_acctbal", "c_name"):
        assert unused not in schemas


@pytest.fixture(scope="module")
def loaded(spark, shared_csv, tmp_path_factory):
    from saldero.sources.sales import load_source

    lake = Lake(str(tmp_path_factory.mktemp("plans") / "lake"))
    sales = load_source(spark, shared_csv)
    jobs.backfill(sales, dt.date(2022, 1, 30), dt.date(2022, 2, 2), lake)
    jobs.curate_range(spark, dt.date(2022, 1, 30), dt.date(2022, 2, 2), lake)
    warehouse.refresh_tables(spark, lake)
    return lake


def test_month_slicer_prunes_partitions_of_both_facts(spark, loaded):
    february = report.Selection(months=[dt.date(2022, 2, 1)])
    views = warehouse.open_marts(spark, loaded)
    stored = warehouse.import_marts(spark, loaded, views)
    for model in (views, stored):
        for fact in (february.monthly(model), february.daily(model)):
            filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", physical(fact))
            assert filters and all("mes" in f and "2022-02-01" in f for f in filters)


@pytest.mark.parametrize("build", [report.secondary_cards, report.daily_trend])
def test_looks_back_read_only_the_month_before(spark, loaded, build):
    february = report.Selection(months=[dt.date(2022, 2, 1)])
    stored = warehouse.import_marts(spark, loaded, warehouse.open_marts(spark, loaded))
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", physical(build(stored, february)))
    assert any("mes" in f and "2022-01-01" in f and "2022-02-01" in f for f in filters)


def test_the_sales_are_read_once_for_all_marts(spark, loaded):
    views = warehouse.open_marts(spark, loaded)
    months = marts.dealer_months(views.by_region)
    daily = marts.regions_to_days(views.by_region)
    derived = views.over(*[spark.createDataFrame([], f.schema) for f in (daily, months)])
    for frame in (derived.kpi_mensual, derived.dim_concesionaria, derived.dim_fecha):
        assert "/ventas" not in physical(frame)


def test_dealer_filter_reaches_the_scan(spark, loaded):
    one = report.Selection(dealers=["Sur"])
    plan = physical(one.monthly(warehouse.open_marts(spark, loaded)))
    assert re.search(r"PushedFilters: \[[^\]]*dealer_name[^\]]*Sur", plan)


def test_a_hot_day_is_split_over_files(spark, tmp_path):
    """Two thirds of the rows on one day: many tasks write it, small days in few files."""
    import glob

    rows = spark.range(300_000).select(
        F.expr("if(id % 3 < 2, date'2022-01-01', date_add(date'2022-01-02', int(id % 7)))").alias(
            "sale_date"
        ),
        F.sha2(F.col("id").cast("string"), 256).alias("car_id"),
    )
    path = Lake(str(tmp_path)).path(RAW_SALES)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        write_partitions(rows, path, "sale_date")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {
        d.split("=")[-1]: len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{path}/sale_date=*")
    }
    hot = files.pop("2022-01-01")
    assert len(files) == 7
    assert hot >= 8 and hot >= 2 * max(files.values())
    assert spark.read.parquet(path).distinct().count() == 300_000
