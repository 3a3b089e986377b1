"""The days on which each sale id was seen, bucketed by id.

A rule about ids across days has to look at all history. The index keeps one row
per id and day, partitioned by month, bucketed and sorted by id, so that the
arriving rows are brought to the buckets and history is read where it lies: the
plan has no exchange on its side. It holds nothing that the raw layer does not,
and is refreshed by the months a load touches.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import names_below
from ..sources.lake import DAY_PARTITION, ID_INDEX, RAW_SALES, Lake, drop_partitions, read_months
from ..sources.lake import session_settings
from ..sources.sales import SALE_TYPES

BUCKETS = 64


class IdIndex:
    """The index of one lake, under a table name of this session."""

    def __init__(self, spark: SparkSession, lake: Lake, buckets: int = BUCKETS):
        self.spark, self.lake, self.buckets = spark, lake, buckets
        # another number of buckets is another table
        self.path = lake.path(f"{ID_INDEX}/{buckets}")
        self.table = f"sale_ids_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (car_id STRING, sale_date DATE, month STRING)"
            " USING parquet PARTITIONED BY (month) CLUSTERED BY (car_id) SORTED BY (car_id)"
            f" INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )
        if names_below(spark, self.path):
            spark.catalog.recoverPartitions(self.table)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def refresh(self, months: Iterable[dt.date]) -> None:
        """Take these months anew from the raw layer; one without ids leaves the index."""
        wanted = sorted({m.replace(day=1) for m in months})
        raw = read_months(self.spark, self.lake.path(RAW_SALES), wanted, SALE_TYPES)
        labels = {f"{m:%Y-%m}" for m in wanted}
        if raw is not None:
            month = F.date_format(DAY_PARTITION, "yyyy-MM").alias("month")
            ids = raw.where(F.col("car_id").isNotNull()).select("car_id", DAY_PARTITION, month)
            # one row per id and day, brought to its bucket once
            placed = ids.distinct().repartition(self.buckets, "car_id")
            with session_settings(
                self.spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}
            ):
                placed.write.insertInto(self.table, overwrite=True)
            found = {f"{r[0]:%Y-%m}" for r in raw.select(F.trunc(DAY_PARTITION, "month")).distinct().collect()}
            labels -= found
        for label in sorted(labels):
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION (month = '{label}')")
        drop_partitions(self.spark, self.path, "month", sorted(labels))
        self.spark.catalog.refreshTable(self.table)

    def across_days(self, sales: DataFrame) -> DataFrame:
        """(date, n): rows of each day whose id the index knows from another day.

        The arrivals are counted by id and day first, so a very frequent id is a
        row per day. Rows without an id match nothing.
        """
        counted = sales.groupBy("car_id", "date").agg(F.count(F.lit(1)).alias("n"))
        history = self.rows().select("car_id", F.col(DAY_PARTITION).alias("seen"))
        known = F.col("new.car_id") == F.col("old.car_id")
        other = F.col("new.date") != F.col("old.seen")
        met = counted.alias("new").hint("merge").join(history.alias("old"), known & other, "left_semi")
        return met.groupBy("date").agg(F.sum("n").alias("n"))

    def close(self) -> None:
        """Forget the name; the files stay for the next session."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


@contextmanager
def id_index(spark: SparkSession, lake: Lake, buckets: int = BUCKETS) -> Iterator[IdIndex]:
    index = IdIndex(spark, lake, buckets)
    try:
        yield index
    finally:
        index.close()
