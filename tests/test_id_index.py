"""Ids repeated across days, by an index whose side of the join is not shuffled."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from saldero.plans import jobs
from saldero.plans.id_index import IdIndex, id_index
from saldero.sources.lake import DAY_PARTITION, RAW_SALES, drop_partitions

FIRST, LAST = dt.date(2022, 1, 30), dt.date(2022, 2, 2)


def found(index, sales):
    return {r["date"]: r["n"] for r in index.across_days(sales).collect()}


@pytest.fixture
def index(spark, lake):
    with id_index(spark, lake, buckets=4) as one:
        yield one


def sales_of(spark, *rows):
    return spark.createDataFrame(list(rows), "car_id string, date date")


def test_ids_seen_on_another_day(spark, shared_sales, lake, index):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    index.refresh([FIRST, LAST])
    assert index.rows().count() == 24
    assert found(index, shared_sales) == {}
    later = dt.date(2022, 3, 1)
    arrived = sales_of(spark, ("C000", later), ("C000", later), ("C023", later), ("new", later), (None, later))
    assert found(index, arrived) == {later: 3}
    moved = sales_of(spark, ("C000", FIRST), ("C000", LAST), ("C023", FIRST))
    assert found(index, moved) == {LAST: 1, FIRST: 1}


def test_an_empty_index_and_no_arrivals(spark, shared_sales, lake, index):
    assert found(index, shared_sales) == {}
    index.refresh([])
    index.refresh([FIRST])
    assert found(index, shared_sales.limit(0)) == {}


def test_refreshed_months_replace_what_they_held(spark, shared_sales, lake, index):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    index.refresh([FIRST, LAST])
    drop_partitions(spark, lake.path(RAW_SALES), DAY_PARTITION, ["2022-01-30", "2022-01-31"])
    jobs.backfill(shared_sales.withColumn("car_id", F.concat("car_id", F.lit("x"))), LAST, LAST, lake)
    index.refresh([FIRST, LAST])
    kept = sorted(r["car_id"] for r in index.rows().collect())
    assert kept == [f"C{n:03d}" for n in range(12, 18)] + [f"C{n:03d}x" for n in range(18, 24)]
    index.refresh([FIRST, LAST])
    assert index.rows().count() == 12


def test_the_index_is_found_again_under_another_name(spark, shared_sales, lake):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    with id_index(spark, lake, buckets=4) as one:
        one.refresh([FIRST, LAST])
        name = one.table
    assert not spark.catalog.tableExists(name)
    with id_index(spark, lake, buckets=4) as other:
        assert other.rows().count() == 24


def test_history_is_read_where_it_lies(spark, shared_sales, lake):
    jobs.backfill(shared_sales, FIRST, LAST, lake)
    index = IdIndex(spark, lake, buckets=8)
    index.refresh([FIRST, LAST])
    plan = index.across_days(shared_sales)._jdf.queryExecution().executedPlan().toString()
    index.close()
    assert "SortMergeJoin" in plan
    # below the scan of the index there is no exchange between it and the join
    right = plan[plan.index("sale_ids_") - 2000 : plan.index("sale_ids_")]
    between = right[right.rindex("Sort [") :]
    assert "Exchange" not in between
    assert re.search(r"Bucketed: true", plan)


def test_a_frequent_id_is_a_row_per_day(spark, lake, index):
    rows = spark.range(20_000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id AS string)) AS car_id", "date_add(date'2022-01-01', int(id % 28)) AS date"
    )
    other = {c: F.lit("x") for c in ("dealer_name", "company", "model", "dealer_region")}
    whole = rows.withColumns({**other, "price": F.lit(1.0), DAY_PARTITION: F.col("date")})
    from saldero.sources.lake import write_partitions

    write_partitions(whole, lake.path(RAW_SALES), DAY_PARTITION)
    index.refresh([dt.date(2022, 1, 1)])
    assert index.rows().where("car_id = 'hot'").count() == 28
    assert sum(found(index, rows).values()) == rows.where("car_id = 'hot'").count()
