"""Money types, rounding and the safe arithmetic of the KPI layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Computed amounts are whole cents; 18 digits stay in Spark's compact long form.
AMOUNT = T.DecimalType(18, 2)
# A source price keeps nine fractional digits and has room for nineteen integer
# digits; its sums still fit the widest decimal.
PRICE = T.DecimalType(28, 9)


def to_cents(value: Column) -> Column:
    """Round a double to cents, ties to even on the scaled value."""
    return F.rint(value * F.lit(100.0)) / F.lit(100.0)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio, null when the denominator is zero or either side is null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def blank_minus(left: Column, right: Column) -> Column:
    """Subtraction where one missing side counts as zero and two stay missing."""
    zero = F.lit(0)
    return F.when(
        left.isNotNull() | right.isNotNull(),
        F.coalesce(left, zero) - F.coalesce(right, zero),
    )


def row_sum(*columns: Column) -> Column:
    """Sum across columns, a missing one counting as zero."""
    total = F.coalesce(columns[0], F.lit(0.0))
    for column in columns[1:]:
        total = total + F.coalesce(column, F.lit(0.0))
    return total


def nan_to_null(column: Column) -> Column:
    """Spark orders NaN above every number, so it must not reach a predicate."""
    return F.when(~F.isnan(column), column)


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Exact decimals inside, doubles at the output edge."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
