"""Golden rows, time intelligence over gaps, ranking ties and blanks."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saldero.operators.enrich import (
    add_costs,
    monthly_base,
    monthly_expenses,
    monthly_targets,
    with_position,
)
from saldero.operators.ranking import top_n, with_leader
from saldero.operators.timeintel import moving_mean_7d, with_previous_month
from saldero.operators.waterfall import STEPS
from saldero.plans import marts as m
from saldero.plans import report
from saldero.plans.marts import Marts
from saldero.plans.metrics import BY_LABEL, MEASURES, evaluate

D = dt.date

# Expected monthly rows of the shared fixture. Two tax values fall on half a
# cent (30% of an odd number of five-cent units), where the rounded result
# depends on the last bit of the profit sum; these follow from exact sums.
GOLDEN = {
    ("Norte", "2022-01"): (4058.50, 2061.66, 765.74, 555.86, 555.17, 267.51, 2617.55, 112650.56),
    ("Norte", "2022-02"): (5985.45, 2290.83, 2055.53, 1687.12, 495.25, 557.61, 2843.00, 161135.49),
    ("Sur", "2022-01"): (3446.73, 2154.63, 1045.35, 626.11, 534.41, 225.95, 2309.39, 98044.40),
    ("Sur", "2022-02"): (4750.70, 2621.42, 2026.70, 1010.91, 622.39, 1095.89, 2786.92, 163495.71),
}


@pytest.fixture
def curated(shared_sales):
    return add_costs(shared_sales)


def test_golden_sales(curated):
    rows = curated.orderBy("car_id").limit(4).collect()
    assert [(r.car_id, r.costo, r.utilidad_bruta) for r in rows] == [
        ("C000", 11912.54, 3087.46),
        ("C001", 12741.44, 2758.56),
        ("C002", 13953.13, 2046.87),
        ("C003", 13180.67, 3319.33),
    ]


def test_golden_months(curated):
    base = monthly_base(curated)
    both = monthly_expenses(base).join(monthly_targets(base), ["dealer_name", "mes"])
    found = {(r[0], f"{r[1]:%Y-%m}"): tuple(r)[2:] for r in both.collect()}
    assert found == GOLDEN


def test_stored_and_in_flight_monthly_facts_agree(curated):
    base = monthly_base(curated)
    ventas = m.typed_sales(curated)
    joined = m.kpi_monthly(
        ventas, m.typed_expenses(monthly_expenses(base)), m.typed_targets(monthly_targets(base))
    )
    direct = m.kpi_monthly_from_sales(ventas)
    assert joined.columns == direct.columns
    assert sorted(map(str, joined.collect())) == sorted(map(str, direct.collect()))


def test_rows_without_a_dealer_stay_in_the_fact_without_expenses(curated):
    bad = curated.withColumn(
        "dealer_name", F.when(F.col("dealer_name") == "Sur", F.col("dealer_name"))
    )
    base = monthly_base(bad)
    assert base.where("dealer_name is null").count() == 0
    ventas = m.typed_sales(bad)
    direct = m.kpi_monthly_from_sales(ventas)
    lost = direct.where("dealer_name is null").collect()
    assert len(lost) == 2 and all(r.opex is None and r.cumplimiento is None for r in lost)
    assert all(r.num_ventas == 6 for r in lost)
    joined = m.kpi_monthly(
        ventas, m.typed_expenses(monthly_expenses(base)), m.typed_targets(monthly_targets(base))
    )
    assert sorted(map(str, joined.collect())) == sorted(map(str, direct.collect()))


def test_prices_keep_their_fraction(spark):
    rows = spark.createDataFrame(
        [("1", D(2022, 1, 1), "A", "R", "Ford", "m", 10.125)],
        "car_id string, date date, dealer_name string, dealer_region string, company string, "
        "model string, price double",
    )
    typed = m.typed_sales(add_costs(rows))
    assert typed.first().precio == Decimal("10.125000000")


def test_margin_range_and_identities(spark):
    from conftest import SMALL

    from testbed import tables as t

    curated = t.curated(spark, SMALL)
    margin = F.col("utilidad_bruta") / F.col("price")
    wide = curated.where((margin < 0.06) | (margin > 0.22))
    assert wide.count() == 0
    kpi = t.marts(spark, SMALL).kpi_mensual
    ratio = F.col("objetivo_ventas").cast("double") / F.col("ventas").cast("double")
    assert kpi.where((ratio < 0.899) | (ratio > 1.151)).count() == 0
    assert kpi.where(F.col("impuestos") < 0).count() == 0


def test_costs_need_a_key(curated):
    with pytest.raises(ValueError):
        add_costs(curated.drop("car_id"))


def test_positions_count_from_zero_in_each_day(shared_sales):
    placed = with_position(shared_sales.drop("car_id"), ["price"])
    found = {}
    for row in placed.orderBy("date", "price").collect():
        found.setdefault(row.date, []).append(row.position)
    assert list(found.values()) == [[0, 1, 2, 3, 4, 5]] * 4
    assert add_costs(placed, "position").count() == 24


def test_mean_over_gaps_and_blanks(spark):
    daily = spark.createDataFrame(
        [("A", D(2022, 1, 1), 70.0), ("A", D(2022, 1, 3), 7.0), ("B", D(2022, 1, 12), 14.0)],
        "dealer_name string, fecha date, ventas double",
    )
    calendar = m.dim_date(daily)
    total = moving_mean_7d(daily, calendar).orderBy("fecha").collect()
    assert len(total) == 12
    means = [r.ventas_media_7d for r in total]
    assert means == [10.0, 10.0, 11.0, 11.0, 11.0, 11.0, 11.0, 1.0, 1.0, None, None, 2.0]
    assert [r.ventas for r in total][:3] == [70.0, None, 7.0]
    keyed = moving_mean_7d(daily, calendar, ["dealer_name"])
    assert keyed.where("dealer_name = 'A'").count() == 9
    assert keyed.where("dealer_name = 'B'").count() == 1


def test_previous_month_over_gaps(spark):
    monthly = spark.createDataFrame(
        [("A", D(2022, 1, 1), 10.0), ("A", D(2022, 2, 1), 15.0), ("A", D(2022, 5, 1), 30.0)],
        "dealer_name string, mes date, ventas double",
    )
    months = spark.createDataFrame([(D(2022, i, 1),) for i in range(1, 6)], "mes date")
    rows = with_previous_month(monthly, months, ["dealer_name"]).orderBy("mes").collect()
    assert [tuple(r)[1:] for r in rows] == [
        (D(2022, 1, 1), 10.0, None, None),
        (D(2022, 2, 1), 15.0, 10.0, 0.5),
        (D(2022, 3, 1), None, 15.0, -1.0),
        (D(2022, 5, 1), 30.0, None, None),
    ]


def test_ties_all_lead_and_all_stay_in_the_top(spark):
    rows = spark.createDataFrame(
        [(f"d{i}", float(v)) for i, v in enumerate([9, 9, 8, 7, 7, 7, 1])] + [("none", None)],
        "dealer_name string, ventas double",
    )
    led = {r.dealer_name for r in with_leader(rows, rows).where("es_top").collect()}
    assert led == {"d0", "d1"}
    assert with_leader(rows, rows).where("es_top is null").count() == 0
    assert {r.dealer_name for r in top_n(rows, n=4).collect()} == {f"d{i}" for i in range(6)}
    assert top_n(rows, n=50).count() == 7


def test_waterfall_levels_are_running_sums(curated):
    steps = report.waterfall_report(Marts.from_curated(curated)).orderBy("orden").collect()
    assert [(r.paso, r.orden, r.tipo) for r in steps] == list(STEPS)
    level = 0.0
    for row in steps:
        level = row.nivel_paso if row.orden == 1 else level - (row.monto_paso or 0.0)
        assert row.nivel_paso == pytest.approx(level, abs=1e-6)
        assert (row.cascada_total is None) == (row.tipo == "Baja")


def test_missing_lookups_are_skipped_by_sums(curated):
    base = monthly_base(curated)
    expenses = m.typed_expenses(monthly_expenses(base)).where("month(mes) = 1")
    targets = m.typed_targets(monthly_targets(base)).where("month(mes) = 2")
    kpi = m.kpi_monthly(m.typed_sales(curated), expenses, targets)
    row = evaluate(kpi, [], ["ventas", "ebitda", "objetivo_ventas", "pp_vs_objetivo"]).first()
    january = kpi.where("month(mes) = 1").agg(F.sum("ebitda")).first()[0]
    assert row.ebitda == january
    blank = evaluate(kpi.where("month(mes) = 1"), [], ["cumplimiento", "pp_vs_objetivo", "brecha"])
    assert tuple(blank.first()) == (None, -1.0, Decimal("213000.000000000"))


def test_empty_selection_gives_blank_cards(curated):
    model = Marts.from_curated(curated)
    nothing = report.Selection(dealers=["nobody"])
    row = report.headline_cards(model, nothing).first()
    assert row.ventas is None and row.cumplimiento is None and row.color_cumplimiento is None
    cards = report.secondary_cards(model, nothing).first()
    assert cards.pp_vs_objetivo == -1.0 and cards.color_pp == "#C62828"


def test_empty_input_gives_an_empty_calendar(curated):
    model = Marts.from_curated(curated.where("false"))
    assert model.dim_fecha.count() == 0
    assert report.daily_trend(model).count() == 0


def test_the_registry_holds_every_measure():
    assert len(MEASURES) == len(BY_LABEL) == 42


def test_single_dealer_total_is_the_leader(curated):
    matrix = report.dealer_matrix(
        Marts.from_curated(curated), report.Selection(dealers=["Sur"])
    ).collect()
    assert len(matrix) == 2 and all(r.es_top for r in matrix)


def test_month_slicer_scopes(curated):
    model = Marts.from_curated(curated)
    february = report.Selection(months=[D(2022, 2, 1)])
    assert report.sales_against_target(model, february).count() == 2
    assert report.margin_trend(model, february).count() == 2
    assert evaluate(february.monthly(model), ["mes"], ["ventas"]).count() == 1
    trend = report.daily_trend(model, february).orderBy("fecha").collect()
    assert trend[0].fecha == D(2022, 2, 1)
    assert trend[0].ventas_media_7d == pytest.approx((97500 + 115500 + 133500) / 7)


def test_two_month_cards_compare_with_one_month(curated):
    cards = report.secondary_cards(Marts.from_curated(curated)).first()
    assert float(cards.ventas_mes_anterior) == 213000.0
    assert cards.ventas_vs_mes_anterior == (498000.0 - 213000.0) / 213000.0


def test_report_tables_come_in_their_order(curated):
    model = Marts.from_curated(curated)
    matrix = report.dealer_matrix(model).collect()
    sold = [r["ventas"] for r in matrix if not r["is_total"]]
    assert matrix[-1]["is_total"] and sold == sorted(sold, reverse=True)
    ranked = [r["ventas"] for r in report.dealer_ranking(model).collect()]
    assert ranked == sorted(ranked, reverse=True)
    steps = [r["orden"] for r in report.waterfall_report(model).collect()]
    assert steps == list(range(1, 10))
    for rows, key in ((report.margin_trend(model), "mes"), (report.daily_trend(model), "fecha")):
        found = [r[key] for r in rows.collect()]
        assert found == sorted(found)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_wide_prices_are_not_lost(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = spark.createDataFrame(
            [("c", dt.date(2022, 1, 1), "d", "r", "Ford", "m", 2.5e12)],
            "car_id string, date date, dealer_name string, dealer_region string, company string,"
            " model string, price double",
        )
        fact = Marts.from_curated(add_costs(rows)).kpi_mensual.first()
        assert float(fact["ventas"]) == 2.5e12
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
