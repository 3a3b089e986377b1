"""Sets of tables published as one version, and marts merged month by month."""

import datetime as dt
import glob
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from saldero.operators.enrich import add_costs
from saldero.plans import jobs, marts, report, warehouse
from saldero.sources import snapshots
from saldero.sources.errors import LakeNotReady
from saldero.sources.lake import CURATED_SALES, DAY_PARTITION, RAW_SALES, drop_partitions
from saldero.sources.snapshots import PublicationConflict, TableSet

FIRST, LAST = dt.date(2022, 1, 30), dt.date(2022, 2, 2)
JANUARY, FEBRUARY = dt.date(2022, 1, 1), dt.date(2022, 2, 1)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path):
    return TableSet(spark, str(tmp_path / "set"), kept=2)


def numbers(spark, rows, parts=2):
    return spark.range(rows).selectExpr("id", f"id % {parts} AS part")


def publish(tables, rows, parts=2):
    draft = tables.draft()
    draft.write("left", numbers(tables.spark, rows, parts), "part", ("id",))
    draft.write("right", tables.spark.range(rows))
    return draft.publish({"rows": rows})


def seen(tables, version=None):
    left, right = (tables.read(n, version) for n in ("left", "right"))
    return sorted(r["id"] for r in left.collect()), sorted(r["id"] for r in right.collect())


def whole(n):
    return list(range(n)), list(range(n))


def test_versions_are_published_and_read(tables):
    assert tables.current() is None
    with pytest.raises(LakeNotReady):
        tables.read("left")
    first = publish(tables, 4)
    second = publish(tables, 6)
    assert (first.number, second.number) == (1, 2)
    assert seen(tables) == whole(6) and seen(tables, first) == whole(4)
    assert tables.current().ledger == {"rows": 6}
    assert tables.read("left").dtypes == [("id", "bigint"), ("part", "bigint")]


def test_a_reader_keeps_its_version(tables):
    publish(tables, 4)
    open_ = tables.read("left")
    publish(tables, 6)
    assert sorted(r["id"] for r in open_.collect()) == list(range(4))


def test_old_versions_go_and_their_folders_with_them(tables):
    first = publish(tables, 4)
    for rows in (5, 6, 7):
        publish(tables, rows)
    assert [v.number for v in tables.history()] == [3, 4]
    tokens = {f.split("snap=")[1].split("/")[0] for f in glob.glob(f"{tables.root}/**/snap=*/", recursive=True)}
    assert len(tokens) == 2 and not tokens & first.tables["left"].tokens()
    assert seen(tables, tables.history()[0]) == whole(6) and seen(tables) == whole(7)


def test_named_partitions_are_replaced_and_others_shared(tables):
    first = publish(tables, 6, parts=3)
    draft = tables.draft()
    draft.write("left", tables.spark.sql("SELECT 100L AS id, 1L AS part"), "part", only=["1", "2"])
    second = draft.publish()
    assert sorted(map(tuple, tables.read("left").collect())) == [(0, 0), (3, 0), (100, 1)]
    assert second.tables["left"].parts["0"] == first.tables["left"].parts["0"]
    assert second.tables["right"] == first.tables["right"]
    assert tables.read("left", values=["1"]).count() == 1
    draft = tables.draft()
    with pytest.raises(ValueError, match="not named"):
        draft.write("left", numbers(tables.spark, 6, 3), "part", only=["1"])
    draft.remove("left", ["0"])
    draft.publish()
    assert [r["id"] for r in tables.read("left").collect()] == [100]


def test_an_empty_table_keeps_its_columns(tables):
    publish(tables, 0)
    assert seen(tables) == whole(0)
    assert tables.read("left").columns == ["id", "part"]


def test_null_partitions_are_read_back(tables):
    draft = tables.draft()
    draft.write("left", tables.spark.sql("SELECT 1L AS id, cast(null AS date) AS part"), "part")
    draft.publish()
    assert tables.read("left").collect() == [(1, None)]


def test_the_second_of_two_writers_fails(tables):
    publish(tables, 2)
    one, two = tables.draft(), tables.draft()
    one.write("left", numbers(tables.spark, 3), "part")
    two.write("left", numbers(tables.spark, 4), "part")
    one.publish()
    with pytest.raises(PublicationConflict):
        two.publish()
    assert tables.read("left").count() == 3
    publish(tables, 5)
    assert seen(tables) == whole(5)


def test_appended_rows_and_compaction(tables, monkeypatch):
    """Twelve appends to two partitions leave twelve folders each, a compaction one."""
    for n in range(12):
        draft = tables.draft()
        rows = tables.spark.range(n * 10, n * 10 + 10).selectExpr("id", "id % 2 AS part")
        draft.write("left", rows, "part", append=True)
        draft.publish({"batch": n})
    before = tables.current()
    assert {v: len(t) for v, t in before.tables["left"].parts.items()} == {"0": 12, "1": 12}
    everything = sorted(map(tuple, tables.read("left").collect()))
    assert everything == [(n, n % 2) for n in range(120)] or len(everything) == 120
    assert tables.compact("left", small=1) == []
    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "create_text", lambda *a: False)
        with pytest.raises(PublicationConflict):
            tables.compact("left", small=1 << 20)
    assert tables.current() == before
    open_ = tables.read("left")
    assert tables.compact("left", small=1 << 20, sort_by=("id",)) == ["0", "1"]
    after = tables.current()
    assert {v: len(t) for v, t in after.tables["left"].parts.items()} == {"0": 1, "1": 1}
    files = [f for v in "01" for d in tables.folders("left", after.tables["left"], v) for f in glob.glob(f"{d}/*.parquet")]
    assert len(files) == 2 and after.ledger == {"batch": 11}
    for frame in (open_, tables.read("left"), tables.read("left", before)):
        assert sorted(map(tuple, frame.collect())) == everything
    assert tables.compact("left", small=1 << 20) == []


@pytest.mark.parametrize("step", ["first table", "second table", "pointer", "vacuum"])
def test_a_failure_at_any_step_leaves_one_whole_version(tables, monkeypatch, step):
    publish(tables, 4)
    broken = tables.spark.range(6).selectExpr("if(id = 5, raise_error('lost'), id) AS id", "id % 2 AS part")
    broken = broken.selectExpr("cast(id AS long) AS id", "part")
    draft = tables.draft()
    if step == "first table":
        with pytest.raises(Exception, match="lost"):
            draft.write("left", broken, "part")
    elif step == "second table":
        draft.write("left", numbers(tables.spark, 6), "part")
        with pytest.raises(Exception, match="lost"):
            draft.write("right", broken.select("id"))
    else:
        draft.write("left", numbers(tables.spark, 6), "part")
        draft.write("right", tables.spark.range(6))
        with monkeypatch.context() as patch:
            if step == "pointer":
                patch.setattr(snapshots, "create_text", lambda *a: (_ for _ in ()).throw(OSError("gone")))
            else:
                patch.setattr(TableSet, "vacuum", lambda self: (_ for _ in ()).throw(OSError("gone")))
            with pytest.raises(OSError, match="gone"):
                draft.publish()
    assert seen(tables) == whole(6 if step == "vacuum" else 4)
    publish(tables, 8)
    publish(tables, 9)
    assert seen(tables) == whole(9)
    left = {f.split("snap=")[1].strip("/") for f in glob.glob(f"{tables.root}/left/*/snap=*/")}
    used = {t for v in tables.history() for t in v.tables["left"].tokens()}
    assert left == used


@pytest.mark.parametrize("step", range(3))
def test_a_refresh_that_fails_leaves_all_typed_tables(spark, shared_sales, lake, monkeypatch, step):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    warehouse.refresh_tables(spark, lake)
    before = {n: sorted(map(str, f.collect())) for n, f in warehouse.open_tables(spark, lake).items()}
    jobs.backfill(shared_sales.withColumn("price", F.col("price") * 2), FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    write, calls = snapshots.Draft.write, []

    def failing(self, *args, **kwargs):
        calls.append(args[0])
        if len(calls) == step + 1:
            raise OSError("gone")
        return write(self, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(snapshots.Draft, "write", failing)
        with pytest.raises(OSError):
            warehouse.refresh_tables(spark, lake)
    after = {n: sorted(map(str, f.collect())) for n, f in warehouse.open_tables(spark, lake).items()}
    assert after == before
    warehouse.refresh_tables(spark, lake)
    total = warehouse.open_tables(spark, lake)["ventas"].agg(F.sum("precio")).first()[0]
    assert float(total) == 2 * sum(15000 + 500 * i for i in range(24))


def stored_rows(found):
    names = ("kpi_diario", "kpi_mensual", "dim_concesionaria", "dim_fecha", "dim_mes")
    return {n: sorted(map(str, getattr(found, n).collect())) for n in names}


def test_merged_marts_equal_a_full_import(spark, shared_sales, lake, tmp_path):
    """A changed day, a month that loses all its sales, and a day that comes back."""
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    warehouse.refresh_tables(spark, lake)
    assert warehouse.merge_marts(spark, lake) == ["2022-01-01", "2022-02-01"]
    assert warehouse.merge_marts(spark, lake) == []

    def run(sales, day, month):
        for layer in (RAW_SALES, CURATED_SALES):
            drop_partitions(spark, lake.path(layer), DAY_PARTITION, [str(day)])
        if sales is not None:
            jobs.run_daily(sales, day, lake)
        jobs.build_months(spark, [month], lake)
        warehouse.refresh_months(spark, lake, [month])
        return warehouse.merge_marts(spark, lake)

    dearer = shared_sales.withColumn("price", F.col("price") + 1000)
    moved = dearer.withColumn("dealer_region", F.lit("A"))
    assert run(moved, LAST, FEBRUARY) == ["2022-02-01"]
    run(None, FIRST, JANUARY)
    assert run(None, dt.date(2022, 1, 31), JANUARY) == ["2022-01-01"]
    merged = stored_rows(warehouse.open_stored_marts(spark, lake))
    assert [r for r in merged["kpi_mensual"] if "2022, 1" in r] == []
    other = type(lake)(str(tmp_path / "full"))
    full = warehouse.import_marts(spark, other, warehouse.open_marts(spark, lake))
    assert merged == stored_rows(full)
    assert run(dearer, FIRST, JANUARY) == ["2022-01-01"]
    other = type(lake)(str(tmp_path / "again"))
    full = warehouse.import_marts(spark, other, warehouse.open_marts(spark, lake))
    assert stored_rows(warehouse.open_stored_marts(spark, lake)) == stored_rows(full)


def test_a_merge_reads_and_writes_only_its_months(spark, shared_sales, lake):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    warehouse.refresh_tables(spark, lake)
    warehouse.merge_marts(spark, lake)
    tables = warehouse.mart_set(spark, lake)
    before = tables.current()
    warehouse.refresh_months(spark, lake, [FEBRUARY])
    typed = warehouse.typed_set(spark, lake)
    found = warehouse._marts_of(typed, typed.current(), ["2022-02-01"])
    for frame in (found.by_region, found.kpi_mensual):
        files = frame.inputFiles()
        assert files and all("mes=2022-02-01" in f for f in files)
    warehouse.merge_marts(spark, lake)
    after = tables.current()
    for name in ("kpi_diario", "kpi_mensual", "meses_concesionaria"):
        old, new = before.tables[name].parts, after.tables[name].parts
        assert old["2022-01-01"] == new["2022-01-01"] and old["2022-02-01"] != new["2022-02-01"]


def test_marts_of_unknown_origin_are_imported_in_full(spark, shared_sales, lake):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    warehouse.refresh_tables(spark, lake)
    foreign = marts.Marts.from_curated(add_costs(shared_sales.where("car_id < 'C003'")))
    warehouse.import_marts(spark, lake, foreign)
    assert len(warehouse.merge_marts(spark, lake)) == 2
    total = warehouse.open_stored_marts(spark, lake).kpi_diario.agg(F.sum("num_ventas")).first()[0]
    assert total == 24


def test_stored_marts_need_a_publication(spark, lake):
    with pytest.raises(LakeNotReady):
        warehouse.open_stored_marts(spark, lake)


def test_no_sales_are_sorted_to_store_the_marts(spark, shared_sales, lake):
    """Regions and dealers come from hash aggregates; only pairs of them are ordered."""
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    warehouse.refresh_tables(spark, lake)
    views = warehouse.open_marts(spark, lake)
    months = marts.dealer_months(views.by_region)
    derived = views.over(marts.regions_to_days(views.by_region), months)
    frames = [views.by_region, months, derived.kpi_mensual, views.kpi_diario, views.kpi_mensual]
    frames += [f.dim_concesionaria for f in (views, derived)]
    frames += [report.Selection(regions=["R"]).monthly(views), report.Selection(regions=["R"]).daily(views)]
    for frame in frames:
        assert "SortAggregate" not in physical(frame)


def test_files_of_a_split_month_hold_narrow_ranges_of_dealers(spark, lake):
    """300 dealers, one of them with a third of the sales, in one month."""
    rows = spark.range(60_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("car_id"),
        F.expr("date_add(date'2022-01-01', int(id % 31))").alias("fecha"),
        F.lit(JANUARY).alias("mes"),
        F.expr("if(id % 3 = 0, 'D000', format_string('D%03d', id % 300))").alias("dealer_name"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128KB")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        draft = warehouse.typed_set(spark, lake).draft()
        draft.write("ventas", rows, "mes", cluster_by=("dealer_name", "fecha", "car_id"))
        draft.publish()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    files = glob.glob(f"{lake.typed('ventas')}/mes=2022-01-01/*/*.parquet")
    assert len(files) >= 12
    bounds = []
    for file in files:
        meta = pq.ParquetFile(file).metadata
        place = pq.read_schema(file).names.index("dealer_name")
        stats = [meta.row_group(g).column(place).statistics for g in range(meta.num_row_groups)]
        bounds.append((min(s.min for s in stats), max(s.max for s in stats)))
    holding = [sum(low <= f"D{n:03d}" <= high for low, high in bounds) for n in range(300)]
    assert max(holding[1:]) <= 2
    assert holding[0] >= 4
    assert warehouse.typed_set(spark, lake).read("ventas").distinct().count() == 60_000


def test_dealer_filters_reach_clustered_files(spark, shared_sales, lake):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    warehouse.refresh_tables(spark, lake)
    sold = warehouse.open_tables(spark, lake)["ventas"].where("dealer_name = 'Sur'")
    assert re.search(r"PushedFilters: \[[^\]]*dealer_name[^\]]*Sur", physical(sold))
    assert sold.count() == 12
