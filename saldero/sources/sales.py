"""Sales sources: delimited files or any DataFrame, brought to one contract.

``load_source`` makes one narrow pass to learn what a typed reader needs (the
texts of the dates, for their shapes and the order of their fields, and whether
prices and identifiers are numeric). A caller who knows these facts passes a
``SourceProfile`` and saves it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import nan_to_null
from ..functions.text import normalise_header, tokens_to_null
from .date_shapes import PIVOT, DateReading, choose, common_readings, shapes_of, unread
from .errors import SourceError, SourceNotFound, is_absent

# The column contracts of a sales source.
PII_COLUMNS = ("customer_name", "phone", "gender", "annual_income")
REQUIRED_COLUMNS = ("date", "dealer_name", "company", "model", "price")
# What the layers of the lake hold of every sale; a load may lack the last two.
SALE_TYPES = {
    "date": "date",
    "dealer_name": "string",
    "company": "string",
    "model": "string",
    "price": "double",
    "car_id": "string",
    "dealer_region": "string",
}

# A cast alone would also read Java's type suffixes, as in 12000d.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


@dataclass(frozen=True)
class SourceProfile:
    """Facts about one load that its text alone does not declare.

    ``date_format`` is a pattern of Spark's, or what a pass over the dates found.
    """

    date_format: str | DateReading
    numeric_price: bool = True
    integer_ids: bool = False


def choose_csv(spark: SparkSession, root: str, filename: str = "") -> str:
    """The one CSV to read below ``root``: by name, or the only one there is."""
    try:
        # only the path column is read: file contents stay untouched
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.csv")
            .load(root)
            .select("path", F.element_at(F.split("path", "/"), -1).alias("name"))
        )
    except AnalysisException as error:
        if not is_absent(error):
            raise
        raise SourceNotFound(f"no such source directory: {root}") from error

    fits = F.col("name") == filename if filename else F.lit(True)
    # the names of a source folder, which its listing has brought to the driver anyway
    seen = files.agg(
        F.count_if(fits).alias("fitting"),
        F.min(F.when(fits, F.col("path"))).alias("path"),
        F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("names"),
    ).first()
    if seen["fitting"] == 1:
        return seen["path"]
    wanted = f"{filename!r}" if filename else "one CSV file"
    error = SourceError if seen["fitting"] else SourceNotFound
    raise error(
        f"expected {wanted} below {root}, {seen['fitting']} fit; the folder holds: "
        f"{seen['names'] or 'nothing'}"
    )


def normalise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalise_header(c) for c in df.columns])


def check_contract(df: DataFrame) -> DataFrame:
    """Fail before any job runs when a required column is missing."""
    missing = sorted(set(REQUIRED_COLUMNS) - set(df.columns))
    if missing:
        raise SourceError(f"columns missing from the source: {missing}")
    return df


def drop_pii(df: DataFrame) -> DataFrame:
    return df.drop(*PII_COLUMNS)


def text_columns(raw: DataFrame) -> DataFrame:
    """Normalised headers and missing-value tokens as null on an all-text frame."""
    named = normalise_columns(raw)
    return named.select(*[tokens_to_null(F.col(c)).alias(c) for c in named.columns])


def read_csv_text(
    spark: SparkSession,
    path: str | list[str],
    *,
    multiline: bool = False,
    path_col: str | None = None,
) -> DataFrame:
    """All columns as text, headers normalised, missing-value tokens as null.

    ``multiline`` allows line breaks inside quotes, at the price of files that
    cannot be split between tasks. ``path_col`` adds the file of each row.
    """
    raw = (
        spark.read.option("header", "true")
        .option("escape", '"')
        .option("enforceSchema", "false")
        .option("multiLine", str(multiline).lower())
        .csv(path)
    )
    if path_col is None:
        return text_columns(raw)
    named = normalise_columns(raw).select("*", F.col("_metadata.file_path").alias(path_col))
    tokens = [tokens_to_null(F.col(c)).alias(c) for c in named.columns if c != path_col]
    return named.select(*tokens, path_col)


def _parsed(date_format: str | DateReading) -> Column:
    if isinstance(date_format, DateReading):
        return date_format.parse(F.col("date"))
    parsed = F.to_date(F.try_to_timestamp(F.col("date"), F.lit(date_format)))
    if "yy" in date_format and "yyyy" not in date_format:
        first = 2000 + PIVOT
        parsed = F.when(F.year(parsed) >= first, F.add_months(parsed, -1200)).otherwise(parsed)
    return parsed


def _price() -> Column:
    """The price as a number, null where the text is none."""
    return F.when(F.col("price").rlike(NUMBER), F.col("price").try_cast("double"))


def profile_source(text: DataFrame, *, refuse_ambiguous: bool = False) -> SourceProfile:
    """What the date, price and id columns of an all-text frame are.

    One pass over the rows tests prices and ids by text of the date and keeps
    these counts. The shapes of the dates and then the orders of fields that they
    allow are found from each text once. A load whose dates fit month first and
    day first alike is read month first, unless it is to be refused.
    """
    has_id = "car_id" in text.columns
    tests = [
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("price").isNotNull() & _price().isNull()).alias("bad_price"),
    ]
    if has_id:
        car_id = F.col("car_id")
        tests.append(
            F.count_if(car_id.isNull() | car_id.try_cast("bigint").isNull()).alias("text_ids")
        )
    # one row per text of a date, read by both looks at them
    dates = text.groupBy("date").agg(*tests).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        shapes = shapes_of(dates, counted="n")
        readings = common_readings(shapes)
        sums = [F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in ("bad_price", "text_ids")[: 1 + has_id]]
        found = dates.agg(*unread(readings, counted="n"), *sums).first()
    finally:
        dates.unpersist()
    return SourceProfile(
        date_format=choose(readings, found, shapes, refuse_ambiguous),
        numeric_price=found["bad_price"] == 0,
        integer_ids=has_id and found["text_ids"] == 0,
    )


def type_columns(text: DataFrame, profile: SourceProfile) -> DataFrame:
    """Typed date, price and id; every other column passes through as text."""
    unreadable = F.raise_error(F.concat(F.lit("unreadable sale date: "), F.col("date")))
    typed = {
        "date": F.when(
            F.col("date").isNotNull(), F.coalesce(_parsed(profile.date_format), unreadable)
        )
    }
    if profile.numeric_price:
        unread = F.raise_error(F.concat(F.lit("unreadable price: "), F.col("price")))
        typed["price"] = F.when(F.col("price").isNotNull(), F.coalesce(_price(), unread))
    if profile.integer_ids:
        typed["car_id"] = F.col("car_id").cast("bigint").cast("string")
    return text.withColumns(typed)


def type_or_mark(text: DataFrame, profile: SourceProfile, mark: str) -> DataFrame:
    """``type_columns`` for loads that go on: ``mark`` tells the rows with an unreadable value."""
    date, price = _parsed(profile.date_format), _price()
    unreadable = F.col("date").isNotNull() & date.isNull()
    typed = {"date": date}
    if profile.numeric_price:
        unreadable = unreadable | (F.col("price").isNotNull() & price.isNull())
        typed["price"] = price
    if profile.integer_ids:
        typed["car_id"] = F.col("car_id").try_cast("bigint").cast("string")
    return text.withColumns({**typed, mark: unreadable})


def load_source(
    spark: SparkSession,
    path: str,
    profile: SourceProfile | None = None,
    *,
    multiline: bool = False,
    refuse_ambiguous: bool = False,
) -> DataFrame:
    """A CSV (file or directory) as a sales frame without personal data.

    Prices that are not all numeric stay text, so that the raw quality rule on
    the type reports them; an unreadable date fails the load.
    """
    text = drop_pii(check_contract(read_csv_text(spark, path, multiline=multiline)))
    found = profile or profile_source(text, refuse_ambiguous=refuse_ambiguous)
    return type_columns(text, found)


def prepare_sales(df: DataFrame) -> DataFrame:
    """The same contract for a frame that already has types (Parquet, a table)."""
    named = drop_pii(check_contract(normalise_columns(df)))
    columns = {}
    for field in named.schema.fields:
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            columns[field.name] = nan_to_null(F.col(field.name))
    if isinstance(named.schema["price"].dataType, T.NumericType):
        # one price type in every partition, whatever type a load came with
        columns["price"] = nan_to_null(F.col("price").cast("double"))
    if isinstance(named.schema["date"].dataType, (T.TimestampType, T.TimestampNTZType)):
        columns["date"] = F.to_date("date")
    if "car_id" in named.columns:
        columns["car_id"] = F.col("car_id").cast("string")
    return named.withColumns(columns) if columns else named
