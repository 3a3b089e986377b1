"""The Parquet lake: one directory per layer, one partition per day or month.

Writers use dynamic partition overwrite, so a job replaces exactly the
partitions it has rows for and a repeated run leaves the same content. No job
reads and overwrites the same directory.
"""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import remove_path
from .errors import is_absent
from .files import names_below

# Layer directories and partition columns.
LANDED = "landed"
RAW_SALES = "raw/ventas"
CURATED_SALES = "curated/ventas"
CURATED_EXPENSES = "curated/gastos_mensuales"
CURATED_TARGETS = "curated/objetivos"
DAY_PARTITION = "sale_date"
MONTH_PARTITION = "month"

TYPED_TABLES = "typed"
MARTS = "marts"
CONTROL = "control"
ID_INDEX = "ids"

WRITE_SETTINGS = {
    # splitting a partition value with a large share of the rows is adaptive work
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # A partition value is one file however its bucket is merged with others, so
    # merging small buckets saves no file and only costs parallel file opens.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
}
# Fixed value: the directory name of a missing partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@dataclass(frozen=True)
class Lake:
    """Locations below one root on any file system Spark can reach."""

    root: str

    def path(self, layer: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}"

    def typed(self, table: str) -> str:
        return self.path(f"{TYPED_TABLES}/{table}")

    def mart(self, view: str) -> str:
        return self.path(f"{MARTS}/{view}")


@contextlib.contextmanager
def session_settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of one write."""
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def write_partitions(
    df: DataFrame,
    path: str,
    partition: str,
    sort_by: Iterable[str] = (),
    *,
    replace_all: bool = False,
) -> None:
    """Write ``df`` with one directory per value of ``partition``.

    The rebalance hint groups rows by partition value so that a small day ends
    in one file, and lets adaptive execution split a value that holds a large
    share of the rows over many tasks and files. Only the partitions present
    in ``df`` are replaced, unless ``replace_all`` asks for the whole table: the
    partitions that ``df`` lacks are then removed once all others are in place,
    so a write that fails leaves the old table whole.
    """
    spark = df.sparkSession
    before = set(names_below(spark, path)) if replace_all else set()
    arranged = df.hint("rebalance", partition).sortWithinPartitions(partition, *sort_by)
    written = Observation()
    values = F.collect_set(F.coalesce(F.col(partition).cast("string"), F.lit(NULL_PARTITION)))
    # one short value per partition, which the writer lists as well
    observed = arranged.observe(written, values.alias("values")) if replace_all else arranged
    with session_settings(spark, WRITE_SETTINGS):
        (
            observed.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(path)
        )
    if replace_all:
        kept = {f"{partition}={value}" for value in written.get["values"]}
        for name in before - kept:
            if name.startswith(f"{partition}="):
                remove_path(spark, f"{path}/{name}")


def drop_partitions(spark: SparkSession, path: str, partition: str, values: Iterable[str]) -> None:
    """Remove whole partitions, as a day or month without rows needs it; missing ones are fine."""
    for value in values:
        remove_path(spark, f"{path}/{partition}={value}")


def layer_schema(columns: dict[str, str], partition: str) -> str:
    """The declared schema of a layer of sales; the partition is a day."""
    return ", ".join(f"{name} {kind}" for name, kind in {**columns, partition: "date"}.items())


def read_layer(
    spark: SparkSession,
    path: str,
    *,
    schema: str | StructType | None = None,
    base: str | None = None,
) -> DataFrame | None:
    """A Parquet layer, or None when it holds no files yet.

    With a declared ``schema`` no footer is opened before the scan, and a column
    that a file lacks reads as null.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if base is not None:
        reader = reader.option("basePath", base)
    # listing takes place in this call: one task per core, not one per directory
    listing = {_LISTING_TASKS: str(spark.sparkContext.defaultParallelism)}
    try:
        with session_settings(spark, listing):
            return reader.parquet(path)
    except AnalysisException as error:
        if is_absent(error):
            return None
        raise


def read_days(
    spark: SparkSession,
    path: str,
    start: dt.date,
    end: dt.date,
    columns: dict[str, str],
    base: str | None = None,
) -> DataFrame | None:
    """Day partitions of an inclusive range, None when there are none.

    Only the directories of the touched months are listed.
    """
    day = F.col(DAY_PARTITION)
    months = _months_between(start, end)
    layer = read_months(spark, path, months, columns, base)
    return None if layer is None else layer.where(day.between(F.lit(start), F.lit(end)))


def read_months(
    spark: SparkSession,
    path: str,
    months: Iterable[dt.date],
    columns: dict[str, str],
    base: str | None = None,
) -> DataFrame | None:
    """All day partitions of the given months, None when there are none."""
    prefixes = ",".join(f"{m:%Y-%m}-*" for m in sorted(months))
    if not prefixes:
        return None
    pattern = f"{path}/{DAY_PARTITION}={{{prefixes}}}"
    return read_layer(spark, pattern, schema=layer_schema(columns, DAY_PARTITION), base=base or path)


def _months_between(start: dt.date, end: dt.date) -> list[dt.date]:
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [dt.date(n // 12, n % 12 + 1, 1) for n in range(first, last + 1)]
