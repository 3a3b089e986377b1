"""What the jobs remember of the days they curated.

One short row per day: how many rows it has, the fingerprint of the raw rows and
the limits it was curated under, the fingerprint of the curated rows, and whether
the monthly tables have been built from it. The table is published like any other
set, one partition per month, so a run replaces the months it touches and a run
that fails forgets nothing that is still true.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.lake import CONTROL, MONTH_PARTITION, Lake
from ..sources.snapshots import TableSet

DAYS = "dias"
_TYPES = "day date, n_rows long, source string, content string, monthly boolean, month string"


@dataclass(frozen=True)
class DayRecord:
    """A curated day. ``source`` names the raw content and the limits it was made under."""

    day: dt.date
    n_rows: int
    source: str
    content: str
    monthly: bool


def control_set(spark: SparkSession, lake: Lake) -> TableSet:
    return TableSet(spark, lake.path(CONTROL))


def _labels(days: Iterable[dt.date]) -> list[str]:
    return sorted({f"{d:%Y-%m}" for d in days})


def read_days(spark: SparkSession, lake: Lake, months: list[str] | None = None) -> DataFrame:
    """The records of some months, or all."""
    tables = control_set(spark, lake)
    version = tables.current()
    if version is None or DAYS not in version.tables:
        return spark.createDataFrame([], _TYPES)
    return tables.read(DAYS, version, months)


def known_days(spark: SparkSession, lake: Lake, days: list[dt.date]) -> dict[dt.date, DayRecord]:
    """The records of the months of ``days``: one short row per day reaches the driver."""
    rows = read_days(spark, lake, _labels(days)).drop(MONTH_PARTITION).collect()
    return {r["day"]: DayRecord(**r.asDict()) for r in rows}


def remember(
    spark: SparkSession, lake: Lake, forget: Iterable[dt.date], records: Iterable[DayRecord] = ()
) -> None:
    """Drop the records of some days and add others, in one publication."""
    records, gone = list(records), set(forget)
    touched = _labels([*gone, *(r.day for r in records)])
    if not touched:
        return
    before = read_days(spark, lake, touched).collect()
    replaced = gone | {r.day for r in records}
    kept = [tuple(r) for r in before if r["day"] not in replaced]
    if not records and len(kept) == len(before):
        return
    fresh = [(r.day, r.n_rows, r.source, r.content, r.monthly, f"{r.day:%Y-%m}") for r in records]
    # a row per day of the months in hand
    rows = spark.createDataFrame([*kept, *fresh], _TYPES).coalesce(1)
    draft = control_set(spark, lake).draft()
    draft.write(DAYS, rows, MONTH_PARTITION, ("day",), only=touched)
    draft.publish()


def day_states(raw: DataFrame, records: DataFrame, by: str, source) -> DataFrame:
    """(day, n_rows, known): whether a raw day is the one its record was made from.

    ``raw`` has the fingerprints per day; ``source`` makes the record's key from them.
    """
    keyed = raw.select(F.col(by).alias("day"), "n_rows", source.alias("_source"))
    joined = keyed.join(records.select("day", "source", "monthly"), "day", "left")
    known = (F.col("source") == F.col("_source")) & F.col("monthly")
    return joined.select("day", "n_rows", F.coalesce(known, F.lit(False)).alias("known"))
