"""The visuals of a page from one pass equal the visuals alone."""

import datetime as dt

import pytest
from conftest import SMALL

from saldero.functions.money import decimals_to_double
from saldero.plans import page, report
from testbed import tables as t

ALONE = {
    "R1": report.headline_cards,
    "R2": report.secondary_cards,
    "R3": report.sales_against_target,
    "R4": report.margin_trend,
    "R6": report.dealer_ranking,
    "R8": report.dealer_matrix,
}
SELECTIONS = {
    "everything": report.EVERYTHING,
    "months and regions": t.SLICE,
    "months and dealers": t.DEALER_SLICE,
    "no such month": report.Selection(months=[dt.date(1900, 1, 1)]),
    "no such dealer": report.Selection(dealers=["nobody"]),
}


def rows(frame):
    return [tuple(r) for r in decimals_to_double(frame).collect()]


@pytest.mark.parametrize("name", SELECTIONS)
def test_a_page_equals_its_visuals(spark, name):
    marts, selection = t.marts(spark, SMALL), SELECTIONS[name]
    found = page.page(marts, selection)
    assert set(found) == set(ALONE)
    for visual, build in ALONE.items():
        alone = build(marts, selection)
        assert found[visual].columns == alone.columns
        # rows in their order, as the visuals show them
        assert rows(found[visual]) == rows(alone), visual


def test_the_fact_is_read_once_for_a_page(spark):
    """The visuals rest on the stored levels, none reads an order again."""
    marts = t.marts(spark, SMALL)
    for visual, frame in page.page(marts, t.DEALER_SLICE).items():
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "levels" in plan
        if visual != "R2":  # the calendar of the model is a dimension, not the fact
            assert "orders.parquet" not in plan


def test_the_levels_are_few_rows(spark):
    found = page.levels(t.marts(spark, SMALL), t.SLICE)
    months, dealers = found.months().count(), found.dealers().count()
    assert found.rows.count() <= 2 * (1 + months + 25) and dealers <= 25
