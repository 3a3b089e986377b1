import datetime as dt

import pytest
from conftest import gap_csv_lines, write_lines
from pyspark.sql import functions as F

from saldero.operators.enrich import add_costs
from saldero.operators.quality import RulesBroken
from saldero.plans import jobs, warehouse
from saldero.sources.errors import LakeNotReady
from saldero.sources.lake import (
    CURATED_EXPENSES,
    CURATED_SALES,
    CURATED_TARGETS,
    RAW_SALES,
    read_layer,
    write_partitions,
)
from saldero.sources.sales import load_source

FIRST, LAST = dt.date(2022, 1, 30), dt.date(2022, 2, 2)


def rows(spark, lake, layer):
    frame = read_layer(spark, lake.path(layer))
    return [] if frame is None else sorted(map(str, frame.collect()))


@pytest.fixture
def gap_sales(spark, tmp_path):
    return load_source(spark, write_lines(tmp_path / "gap.csv", gap_csv_lines()))


def test_backfill_reports_every_day(spark, gap_sales, lake):
    start = dt.date(2022, 1, 1)
    assert list(jobs.backfill(gap_sales, start, dt.date(2022, 1, 4), lake).values()) == [2, 1, 0, 1]
    written = read_layer(spark, lake.path(RAW_SALES)).select("sale_date").distinct().count()
    assert written == 3
    with pytest.raises(ValueError):
        jobs.backfill(gap_sales, start, dt.date(2021, 12, 31), lake)


def test_staged_load_equals_the_direct_one(spark, shared_sales, lake, tmp_path):
    other = type(lake)(str(tmp_path / "staged"))
    direct = jobs.backfill(shared_sales, FIRST, LAST, lake)
    assert jobs.backfill(shared_sales, FIRST, LAST, other, stage=True) == direct
    assert rows(spark, other, RAW_SALES) == rows(spark, lake, RAW_SALES)


def test_sales_without_ids_are_keyed_by_position(spark, shared_sales, lake):
    jobs.backfill(shared_sales.drop("car_id"), FIRST, LAST, lake)
    assert sum(jobs.curate_range(spark, FIRST, LAST, lake).values()) == 24
    first = rows(spark, lake, CURATED_SALES)
    jobs.curate_range(spark, FIRST, LAST, lake)
    assert rows(spark, lake, CURATED_SALES) == first and len(first) == 24


def test_one_day_is_replaced_and_an_empty_day_is_left_alone(spark, gap_sales, lake):
    day = dt.date(2022, 1, 1)
    assert jobs.ingest_day(gap_sales, day, lake) == 2
    assert jobs.ingest_day(gap_sales.where("car_id = '1'"), day, lake) == 1
    assert len(rows(spark, lake, RAW_SALES)) == 1
    assert jobs.ingest_day(gap_sales.where("car_id = '9'"), day, lake) == 0
    assert len(rows(spark, lake, RAW_SALES)) == 1


def test_full_load_writes_the_expected_layers(spark, shared_sales, lake):
    assert sum(jobs.backfill(shared_sales, FIRST, LAST, lake).values()) == 24
    curated = jobs.curate_range(spark, FIRST, LAST, lake)
    assert list(curated.values()) == [6, 6, 6, 6]
    expenses = read_layer(spark, lake.path(CURATED_EXPENSES))
    assert sorted((r.month, r.n) for r in expenses.groupBy("month").agg(F.count("*").alias("n")).collect()) == [
        ("2022-01", 2),
        ("2022-02", 2),
    ]
    assert read_layer(spark, lake.path(CURATED_TARGETS)).count() == 4


def test_runs_are_idempotent(spark, shared_sales, lake):
    layers = (RAW_SALES, CURATED_SALES, CURATED_EXPENSES, CURATED_TARGETS)
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    before = [rows(spark, lake, layer) for layer in layers]
    jobs.backfill(shared_sales.repartition(5), FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    assert [rows(spark, lake, layer) for layer in layers] == before


def test_daily_runs_add_up_to_the_full_load(spark, shared_sales, lake, tmp_path):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    other = type(lake)(str(tmp_path / "daily"))
    for day in (FIRST, dt.date(2022, 1, 31), dt.date(2022, 2, 1), LAST):
        assert jobs.run_daily(shared_sales, day, other) == (6, 6)
    for layer in (RAW_SALES, CURATED_SALES, CURATED_EXPENSES, CURATED_TARGETS):
        assert rows(spark, other, layer) == rows(spark, lake, layer)


def test_curating_without_raw_rows(spark, shared_sales, lake):
    assert jobs.curate_range(spark, FIRST, LAST, lake) == {d: 0 for d in jobs.day_range(FIRST, LAST)}
    jobs.ingest_day(shared_sales, FIRST, lake)
    far = dt.date(2022, 1, 5)
    assert jobs.curate_day(spark, far, lake) == 0
    assert jobs.run_daily(shared_sales, far, lake) == (0, 0)
    assert read_layer(spark, lake.path(CURATED_SALES)) is None


def test_one_day_can_be_curated_alone(spark, shared_sales, lake):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    assert jobs.curate_day(spark, LAST, lake) == 6
    assert len(rows(spark, lake, CURATED_SALES)) == 6
    assert read_layer(spark, lake.path(CURATED_EXPENSES)) is None


def test_replayed_day(spark, shared_sales, lake):
    assert jobs.run_replayed_day(shared_sales, dt.date(2026, 1, 30), 2022, lake) == (6, 6)


def test_bad_day_stops_the_days_after_it(spark, shared_sales, lake):
    price = F.when(F.col("car_id") == "C013", F.lit(-1.0)).otherwise(F.col("price"))
    bad = shared_sales.withColumn("price", price)
    with pytest.raises(RulesBroken, match="raw 2022-02-01: .*price <= 0"):
        jobs.backfill(bad, FIRST, LAST, lake)
    written = {str(r.date) for r in read_layer(spark, lake.path(RAW_SALES)).collect()}
    assert written == {"2022-01-30", "2022-01-31"}


def test_bad_first_day_writes_nothing(spark, shared_sales, lake):
    bad = shared_sales.withColumn("price", F.lit(-1.0))
    with pytest.raises(RulesBroken):
        jobs.backfill(bad, FIRST, LAST, lake)
    assert read_layer(spark, lake.path(RAW_SALES)) is None


def test_bad_curated_day_leaves_months_alone(spark, shared_sales, lake):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    with pytest.raises(RulesBroken, match="curated 2022-01-30"):
        jobs.curate_range(spark, FIRST, LAST, lake, jobs.Limits(margin=(0.9, 0.95)))
    assert read_layer(spark, lake.path(CURATED_SALES)) is None
    assert read_layer(spark, lake.path(CURATED_EXPENSES)) is None


@pytest.mark.parametrize("first_lacks", [True, False])
def test_days_may_lack_the_region(spark, shared_sales, lake, first_lacks):
    bare, full = shared_sales.drop("dealer_region"), shared_sales.withColumn("colour", F.lit("red"))
    jobs.ingest_day(bare if first_lacks else full, FIRST, lake)
    jobs.ingest_day(full if first_lacks else bare, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    warehouse.refresh_tables(spark, lake)
    found = warehouse.open_tables(spark, lake)["ventas"].groupBy("fecha").agg(F.count("dealer_region"))
    lacking, whole = (FIRST, LAST) if first_lacks else (LAST, FIRST)
    assert dict(found.collect()) == {lacking: 0, whole: 6}


def test_a_lake_loaded_without_ids_is_refreshed(spark, shared_sales, lake):
    jobs.backfill(shared_sales.drop("car_id"), FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    warehouse.refresh_tables(spark, lake)
    ids = warehouse.open_tables(spark, lake)["ventas"].where(F.col("fecha") == FIRST)
    assert sorted(r["car_id"] for r in ids.collect()) == [str(n) for n in range(6)]


def test_rows_without_a_date_are_counted(spark, shared_sales, lake):
    undated = shared_sales.withColumn("date", F.when(F.col("car_id") != "C000", F.col("date")))
    counts = jobs.backfill(undated, FIRST, LAST, lake)
    assert (sum(counts.values()), counts.undated) == (23, 1)


def test_a_lost_row_breaks_the_reconciliation(spark, shared_sales, lake, monkeypatch):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    whole = jobs.add_costs
    monkeypatch.setattr(jobs, "add_costs", lambda raw: whole(raw).where("car_id <> 'C003'"))
    with pytest.raises(RulesBroken, match="conciliacion"):
        jobs.curate_range(spark, FIRST, LAST, lake)


def test_jobs_leave_no_staged_rows(spark, shared_sales, lake):
    import os

    from saldero.session import shared_dir

    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    assert not [n for n in set(os.listdir(folder)) - before if n.startswith("stage")]


def test_a_failed_rebuild_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    write_partitions(spark.range(6).selectExpr("id", "id % 3 AS mes"), path, "mes", replace_all=True)
    broken = spark.range(6).selectExpr("if(id = 5, raise_error('lost'), id) AS id", "id % 2 AS mes")
    with pytest.raises(Exception, match="lost"):
        write_partitions(broken.selectExpr("cast(id AS long) AS id", "mes"), path, "mes", replace_all=True)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(6))
    write_partitions(spark.range(4).selectExpr("id", "id % 2 AS mes"), path, "mes", replace_all=True)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(0, 0), (1, 1), (2, 0), (3, 1)]


def test_timestamps_are_stored_in_microseconds(spark, shared_sales, lake, tmp_path):
    import glob

    import pyarrow.parquet as pq

    stamped = shared_sales.withColumn("seen", F.lit(dt.datetime(2022, 1, 1, 12)).cast("timestamp"))
    jobs.ingest_day(stamped, FIRST, lake)
    file = glob.glob(lake.path(RAW_SALES) + "/sale_date=2022-01-30/*.parquet")[0]
    assert "timestamp[us" in str(pq.read_schema(file).field("seen").type)


def test_refresh_needs_every_curated_layer(spark, shared_sales, lake):
    with pytest.raises(LakeNotReady, match="curated/ventas.*gastos_mensuales.*objetivos"):
        warehouse.refresh_warehouse(spark, lake)
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    for day in (FIRST, LAST):
        jobs.curate_day(spark, day, lake)
    with pytest.raises(LakeNotReady) as raised:
        warehouse.refresh_warehouse(spark, lake)
    assert "curated/ventas" not in str(raised.value)
    with pytest.raises(LakeNotReady):
        warehouse.open_marts(spark, lake)


def test_refresh_builds_ten_objects_in_order(spark, shared_sales, lake):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    expected = [
        "ext_ventas", "ext_gastos_mensuales", "ext_objetivos",
        "ventas", "gastos_mensuales", "objetivos",
        "dim_concesionaria", "dim_fecha", "kpi_diario", "kpi_mensual",
    ]
    assert warehouse.refresh_warehouse(spark, lake) == expected
    assert warehouse.refresh_warehouse(spark, lake) == expected
    assert spark.sql("select count(*) from ext_ventas").first()[0] == 24
    assert spark.sql("select sum(num_ventas) from kpi_diario").first()[0] == 24
    assert spark.sql("select count(*) from kpi_mensual where cumplimiento is not null").first()[0] == 4
    types = dict(warehouse.open_tables(spark, lake)["ventas"].dtypes)
    assert types["precio"] == "decimal(28,9)" and types["costo"] == "decimal(18,2)"
    assert types["fecha"] == types["mes"] == "date"


def test_month_refresh_touches_only_its_months(spark, shared_sales, lake):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    warehouse.refresh_tables(spark, lake)
    dearer = shared_sales.withColumn("price", F.col("price") + 1000)
    jobs.backfill(dearer, FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    warehouse.refresh_months(spark, lake, [dt.date(2022, 2, 1)])
    total = warehouse.open_tables(spark, lake)["ventas"].groupBy("mes").agg(F.sum("precio"))
    found = {str(r[0]): float(r[1]) for r in total.collect()}
    assert found == {"2022-01-01": 213000.0, "2022-02-01": 297000.0}


def test_stored_marts_answer_like_the_views(spark, shared_sales, lake):
    from saldero.plans import report

    jobs.backfill(shared_sales, FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    warehouse.refresh_warehouse(spark, lake)
    views = warehouse.open_marts(spark, lake)
    stored = warehouse.import_marts(spark, lake, views)
    for build in (report.dealer_matrix, report.daily_trend, report.secondary_cards):
        assert sorted(map(str, build(stored).collect())) == sorted(map(str, build(views).collect()))


def test_a_day_alone_equals_the_day_in_the_full_set(shared_sales):
    whole = add_costs(shared_sales).where(F.col("date") == F.lit(LAST))
    alone = add_costs(shared_sales.where(F.col("date") == F.lit(LAST)).repartition(3))
    assert sorted(map(str, whole.collect())) == sorted(map(str, alone.collect()))
