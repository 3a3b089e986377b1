"""Fingerprints of days, days left alone, and rows found in place of others."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saldero.operators.fingerprint import fingerprints
from saldero.operators.quality import RulesBroken, issues_of
from saldero.plans import control, jobs
from saldero.sources.lake import (
    CURATED_EXPENSES,
    CURATED_SALES,
    DAY_PARTITION,
    read_layer,
    write_partitions,
)

FIRST, LAST = dt.date(2022, 1, 30), dt.date(2022, 2, 2)
DAYS = [dt.date(2022, 1, 30), dt.date(2022, 1, 31), dt.date(2022, 2, 1), dt.date(2022, 2, 2)]
KIND = "k int, a string, b double, c date"


def mark(spark, rows, parts=1):
    made = spark.createDataFrame([(1, *r) for r in rows], KIND).repartition(parts)
    found = fingerprints(made, "k", ("a", "b", "c")).collect()
    return found[0]["fingerprint"] if found else None


cell = st.tuples(
    st.one_of(st.none(), st.sampled_from(["", "x", "y"])),
    st.one_of(st.none(), st.sampled_from([0.0, 1.5])),
    st.one_of(st.none(), st.just(FIRST)),
)


@settings(max_examples=15, deadline=None)
@given(st.lists(cell, min_size=1, max_size=5), st.lists(cell, min_size=1, max_size=5))
def test_equal_fingerprints_mean_equal_multisets(spark, left, right):
    assert (mark(spark, left) == mark(spark, right)) == (sorted(map(str, left)) == sorted(map(str, right)))


def test_order_and_partitions_do_not_matter(spark):
    rows = [("x", 1.0, FIRST), ("y", None, None), ("x", 1.0, FIRST), (None, 2.0, LAST)]
    assert mark(spark, rows) == mark(spark, rows[::-1], 4)
    assert mark(spark, rows) != mark(spark, rows[1:])
    assert mark(spark, [("x", None, None)]) != mark(spark, [(None, None, None)])


def stored(spark, lake):
    import glob

    found = glob.glob(f"{lake.path(CURATED_SALES)}/sale_date=*/*.parquet")
    return {f.split("sale_date=")[1][:10]: f for f in found}


def test_days_whose_raw_rows_are_known_are_left_alone(spark, shared_sales, lake):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    assert [r["known"] for r in jobs.raw_states(spark, FIRST, LAST, lake).collect()] == [False] * 4
    first = jobs.curate_range(spark, FIRST, LAST, lake)
    files = stored(spark, lake)
    jobs.backfill(shared_sales.repartition(3), FIRST, LAST, lake)
    assert jobs.curate_range(spark, FIRST, LAST, lake) == first
    assert stored(spark, lake) == files
    on_last = (F.col("date") == F.lit(LAST)) & (F.col("car_id") == "C020")
    dearer = F.col("price") + F.when(on_last, 1).otherwise(0)
    jobs.backfill(shared_sales.withColumn("price", dearer), FIRST, LAST, lake)
    states = {r["day"]: r["known"] for r in jobs.raw_states(spark, FIRST, LAST, lake).collect()}
    assert states == {d: d != LAST for d in DAYS}
    assert jobs.curate_range(spark, FIRST, LAST, lake) == first
    now = stored(spark, lake)
    assert {d for d in now if now[d] != files[d]} == {"2022-02-02"}
    total = read_layer(spark, lake.path(CURATED_SALES)).agg(F.sum("price")).first()[0]
    assert total == sum(15000 + 500 * i for i in range(24)) + 1


def test_other_limits_judge_again(spark, shared_sales, lake):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    with pytest.raises(RulesBroken):
        jobs.curate_range(spark, FIRST, LAST, lake, jobs.Limits(margin=(0.9, 0.95)))
    files = stored(spark, lake)
    jobs.curate_range(spark, FIRST, LAST, lake, again=True)
    assert not set(stored(spark, lake).values()) & set(files.values())


def test_a_day_curated_alone_still_builds_its_month_later(spark, shared_sales, lake):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    assert jobs.curate_day(spark, FIRST, lake) == 6
    files = stored(spark, lake)
    assert jobs.curate_day(spark, FIRST, lake) == 6
    assert stored(spark, lake) == files
    assert read_layer(spark, lake.path(CURATED_EXPENSES)) is None
    jobs.curate_range(spark, FIRST, FIRST, lake)
    assert read_layer(spark, lake.path(CURATED_EXPENSES)).count() == 2


@pytest.mark.parametrize("step", ["write_partitions", "build_months"])
def test_a_run_that_fails_half_way_is_done_again(spark, shared_sales, lake, monkeypatch, step):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    dearer = shared_sales.withColumn("price", F.col("price") + 1)
    jobs.backfill(dearer, FIRST, LAST, lake)
    with monkeypatch.context() as patch:
        patch.setattr(jobs, step, lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            jobs.curate_range(spark, FIRST, LAST, lake)
    # back to the first content: what was half written may be of the second
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    assert not any(r["known"] for r in jobs.raw_states(spark, FIRST, LAST, lake).collect())
    jobs.curate_range(spark, FIRST, LAST, lake)
    total = read_layer(spark, lake.path(CURATED_SALES)).agg(F.sum("price")).first()[0]
    assert total == sum(15000 + 500 * i for i in range(24))


def test_a_swapped_row_shows_at_equal_counts(spark, shared_sales, lake):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    jobs.curate_range(spark, FIRST, LAST, lake)
    assert issues_of(jobs.reconcile_days(spark, FIRST, LAST, lake)).count() == 0
    day = read_layer(spark, lake.path(CURATED_SALES)).where(F.col(DAY_PARTITION) == F.lit(LAST))
    swapped = day.withColumn("company", F.when(F.col("car_id") == "C018", "Nissan").otherwise(F.col("company")))
    held = spark.createDataFrame(swapped.collect(), swapped.schema)
    write_partitions(held, lake.path(CURATED_SALES), DAY_PARTITION)
    found = issues_of(jobs.reconcile_days(spark, FIRST, LAST, lake)).collect()
    assert [(r[DAY_PARTITION], r["check"], r["n"]) for r in found] == [(LAST, "conciliacion", 1)]
    assert "no son las de raw" in found[0]["detail"]


def test_records_of_other_months_stay(spark, lake):
    one = control.DayRecord(FIRST, 1, "a", "b", True)
    two = control.DayRecord(LAST, 2, "c", "d", False)
    control.remember(spark, lake, (), [one])
    control.remember(spark, lake, (), [two])
    assert control.known_days(spark, lake, [FIRST, LAST]) == {FIRST: one, LAST: two}
    assert control.known_days(spark, lake, [LAST]) == {LAST: two}
    control.remember(spark, lake, [FIRST])
    assert control.known_days(spark, lake, DAYS) == {LAST: two}
