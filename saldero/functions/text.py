"""Header and text normalisation for delimited sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The source header that carries the price, after normalising.
RENAMED_HEADERS = {"price_($)": "price"}

# Texts a delimited source uses for "missing".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def normalise_header(name: str) -> str:
    plain = name.strip().lower().replace(" ", "_")
    return RENAMED_HEADERS.get(plain, plain)


def tokens_to_null(column: Column) -> Column:
    return F.when(~column.isin(*NULL_TOKENS), column)


def is_blank(column: Column) -> Column:
    """Text made only of white space, Unicode spaces included; null stays null."""
    return column.rlike(r"(?U)^\s*$")
