import datetime as dt
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saldero.functions import bands
from saldero.functions.dates import calendar_attributes, day_range, replay_date, replay_day
from saldero.functions.keyed import keyed_uniform
from saldero.functions.money import blank_minus, nan_to_null, row_sum, safe_ratio, to_cents
from saldero.functions.text import NULL_TOKENS, is_blank, normalise_header, tokens_to_null


def plain_uniform(lo, hi, *keys):
    digest = hashlib.sha256("|".join(map(str, (42, *keys))).encode()).digest()
    return lo + (hi - lo) * (int.from_bytes(digest[:8], "big") / 2**64)


def test_golden_uniforms(spark):
    row = spark.range(1).select(
        keyed_uniform(0, 1, "margen", "'Ford'", "'m1'").alias("a"),
        keyed_uniform(0, 1, "ruido", "'C000'").alias("b"),
        keyed_uniform(0, 1, "nomina", "'Norte'", "'2022-01'").alias("c"),
        keyed_uniform(0, 1, "objetivo", "'Sur'", "'2022-02'").alias("d"),
    )
    assert list(row.first()) == [
        0.993939885129184,
        0.827896531683524,
        0.5768238139847846,
        0.9415474668099786,
    ]


def test_uniform_equals_plain_formula_on_many_keys(spark):
    rows = spark.range(5000).select(
        F.col("id"), keyed_uniform(-0.01, 0.01, "ruido", "id").alias("u")
    )
    assert all(r.u == plain_uniform(-0.01, 0.01, "ruido", r.id) for r in rows.collect())


def test_missing_key_does_not_collapse_the_key_text(spark):
    row = spark.range(1).select(
        keyed_uniform(0, 1, "m", "null", "'x'").alias("u")
    )
    assert row.first().u == plain_uniform(0, 1, "m", None, "x")


@settings(max_examples=3, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9), min_size=200, max_size=200))
def test_cents_equal_numpy_rounding(spark, values):
    rows = spark.createDataFrame([(float(v),) for v in values], "x double")
    mine = [r[0] for r in rows.select(to_cents(F.col("x"))).collect()]
    assert mine == [float(np.round(v, 2)) for v in values]


def test_ratio_and_blank_arithmetic(spark):
    rows = spark.createDataFrame(
        [(1.0, 4.0), (1.0, 0.0), (None, 4.0), (3.0, None), (None, None)], "a double, b double"
    )
    a, b = F.col("a"), F.col("b")
    found = rows.select(safe_ratio(a, b), blank_minus(a, b), row_sum(a, b)).collect()
    assert [tuple(r) for r in found] == [
        (0.25, -3.0, 5.0),
        (None, 1.0, 1.0),
        (None, -4.0, 4.0),
        (None, 3.0, 3.0),
        (None, None, 0.0),
    ]


def test_nan_becomes_null(spark):
    rows = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert [r[0] for r in rows.select(nan_to_null(F.col("x"))).collect()] == [None, 1.0, None]


@pytest.mark.parametrize(
    ("today", "year", "expected"),
    [
        (dt.date(2026, 10, 2), 2022, dt.date(2022, 10, 2)),
        (dt.date(2024, 2, 29), 2022, dt.date(2022, 2, 28)),
        (dt.date(2024, 2, 29), 2020, dt.date(2020, 2, 29)),
        (dt.date(2024, 3, 1), 2022, dt.date(2022, 3, 1)),
    ],
)
def test_replay_date(spark, today, year, expected):
    assert replay_day(today, year) == expected
    assert spark.range(1).select(replay_date(F.lit(today), year)).first()[0] == expected


def test_day_range_is_inclusive_and_ordered():
    assert len(day_range(dt.date(2022, 1, 1), dt.date(2022, 1, 4))) == 4
    with pytest.raises(ValueError):
        day_range(dt.date(2022, 1, 2), dt.date(2022, 1, 1))


def test_calendar_attributes(spark):
    row = spark.range(1).select(*calendar_attributes(F.lit(dt.date(2022, 11, 5)))).first()
    assert tuple(row) == (2022, 11, "November", 4, "Qtr 4", 5)


def test_headers_and_tokens(spark):
    assert normalise_header("  Price ($) ") == "price"
    assert normalise_header("Dealer_Name ") == "dealer_name"
    rows = spark.createDataFrame([(v,) for v in (*NULL_TOKENS, "x", " ")], "t string")
    kept = [r[0] for r in rows.select(tokens_to_null(F.col("t"))).collect() if r[0] is not None]
    assert kept == ["x", " "]


def test_blank_covers_unicode_spaces(spark):
    rows = spark.createDataFrame([("",), ("  ",), ("\t\n",), ("  ",), ("a ",), (None,)], "t string")
    assert [r[0] for r in rows.select(is_blank(F.col("t"))).collect()] == [
        True, True, True, True, False, None,
    ]


def test_bands(spark):
    rows = spark.createDataFrame([(1.0,), (0.95,), (0.9,), (0.2,), (None,), (-1.0,)], "x double")
    x = F.col("x")
    found = rows.select(
        bands.attainment_band(x), bands.attainment_text(x), bands.sign_band(x), bands.sign_text(x)
    ).collect()
    green, amber, red = "#2E7D32", "#F9A825", "#C62828"
    dark, white = "#1F2933", "#FFFFFF"
    assert [tuple(r) for r in found] == [
        (green, white, green, white),
        (amber, dark, green, white),
        (amber, dark, green, white),
        (red, white, green, white),
        (None, None, None, None),
        (red, white, red, white),
    ]
