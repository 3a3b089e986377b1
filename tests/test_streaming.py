import datetime as dt

import pytest
from conftest import shared_csv_lines, write_lines

from saldero.operators.quality import RulesBroken
from saldero.plans import jobs
from saldero.sources.errors import SourceError
from saldero.sources.lake import (
    CURATED_EXPENSES,
    CURATED_SALES,
    CURATED_TARGETS,
    RAW_SALES,
    Lake,
    read_layer,
)
from saldero.sources.sales import SourceProfile, load_source
from saldero.streaming import landing as landing_module
from saldero.streaming.landing import (
    compact_landing,
    drain_landing,
    landed_files,
    landed_sales,
    landed_set,
    quarantine,
    replay_quarantine,
)

DAYS = [dt.date(2022, 1, 30), dt.date(2022, 1, 31), dt.date(2022, 2, 1), dt.date(2022, 2, 2)]
PROFILE = SourceProfile("yyyy-MM-dd")


def content(spark, lake):
    layers = (RAW_SALES, CURATED_SALES, CURATED_EXPENSES, CURATED_TARGETS)
    return [sorted(map(str, read_layer(spark, lake.path(x)).collect())) for x in layers]


def test_files_that_split_a_day_add_up(spark, tmp_path):
    lines = shared_csv_lines()
    landing, profile = tmp_path / "landing", SourceProfile("yyyy-MM-dd")
    lake, checkpoint = Lake(str(tmp_path / "lake")), str(tmp_path / "checkpoint")

    write_lines(landing / "a.csv", lines[:10])
    drain_landing(spark, str(landing), lake, checkpoint, profile)
    assert read_layer(spark, lake.path(RAW_SALES)).count() == 9

    write_lines(landing / "b.csv", [lines[0], *lines[10:]])
    drain_landing(spark, str(landing), lake, checkpoint, profile)

    whole = Lake(str(tmp_path / "whole"))
    sales = load_source(spark, str(landing))
    jobs.backfill(sales, dt.date(2022, 1, 30), dt.date(2022, 2, 2), whole)
    jobs.curate_range(spark, dt.date(2022, 1, 30), dt.date(2022, 2, 2), whole)
    assert content(spark, lake) == content(spark, whole)

    drain_landing(spark, str(landing), lake, checkpoint, profile)
    assert content(spark, lake) == content(spark, whole)


def test_a_bad_day_does_not_stop_the_days_after_it(spark, tmp_path):
    lines = shared_csv_lines()
    bad = [x.replace(",15000,", ",-1,") for x in lines[1:]]
    moved = [x.replace("2022-01-30", "2022-01-31") if n < 6 else x for n, x in enumerate(bad)]
    head = ["2022-01-30".join(x.split("2022-01-31")) for x in lines[7:13]]
    landing, lake = tmp_path / "landing", Lake(str(tmp_path / "lake"))
    write_lines(landing / "a.csv", [lines[0], *head, *moved[:6], *moved[12:]])
    with pytest.raises(RulesBroken, match="price <= 0"):
        drain_landing(spark, str(landing), lake, str(tmp_path / "c"), SourceProfile("yyyy-MM-dd"))
    loaded = {str(r[0]) for r in read_layer(spark, lake.path(RAW_SALES)).select("date").collect()}
    assert loaded == {"2022-01-30", "2022-02-01", "2022-02-02"}


def test_files_may_order_their_columns_differently(spark, tmp_path):
    lines = shared_csv_lines()
    landing, lake = tmp_path / "landing", Lake(str(tmp_path / "lake"))
    write_lines(landing / "a.csv", lines[:10])
    turned = [",".join(reversed(x.split(","))) for x in [lines[0], *lines[10:]]]
    write_lines(landing / "b.csv", turned)
    drain_landing(spark, str(landing), lake, str(tmp_path / "c"), SourceProfile("yyyy-MM-dd"))
    assert read_layer(spark, lake.path(CURATED_SALES)).count() == 24


def test_a_file_that_breaks_the_contract_is_named(spark, tmp_path):
    landing = tmp_path / "landing"
    write_lines(landing / "short.csv", ["Date,Company", "2022-01-30,Ford"])
    with pytest.raises(Exception, match="short.csv"):
        drain_landing(
            spark, str(landing), Lake(str(tmp_path / "l")), str(tmp_path / "c"), SourceProfile("yyyy-MM-dd")
        )


@pytest.fixture
def place(spark, tmp_path):
    """A landing folder, its lake, and a run over them."""

    class Place:
        folder, lake = tmp_path / "landing", Lake(str(tmp_path / "lake"))
        lines = shared_csv_lines()

        def put(self, name, rows):
            write_lines(self.folder / name, [self.lines[0], *rows])

        def day(self, number):
            return self.lines[1 + 6 * number : 7 + 6 * number]

        def drain(self, checkpoint="c", limits=jobs.Limits()):
            drain_landing(spark, str(self.folder), self.lake, str(tmp_path / checkpoint), PROFILE, limits)

        def rows(self, layer=CURATED_SALES):
            found = read_layer(spark, self.lake.path(layer))
            return {} if found is None else {r[0]: r[1] for r in found.groupBy("date").count().collect()}

        def content(self):
            return content(spark, self.lake)

    return Place()


def test_a_bad_day_waits_while_later_files_load_and_a_repaired_file_mends_it(spark, place):
    """A bad day, two later batches, then the repaired file: all days loaded, each once."""
    bad = [place.day(0)[0].replace(",15000,", ",-1,"), *place.day(0)[1:]]
    place.put("a.csv", bad)
    with pytest.raises(RulesBroken, match="raw 2022-01-30: .*price <= 0"):
        place.drain()
    waiting = quarantine(spark, place.lake).collect()
    assert [(r["day"], r["batch"], r["checks"]) for r in waiting] == [(DAYS[0], 0, ["rango"])]
    assert waiting[0]["files"][0].endswith("a.csv") and "price <= 0" in waiting[0]["message"]
    place.put("b.csv", place.day(1))
    place.drain()
    place.put("c.csv", place.day(2) + place.day(3))
    place.drain()
    assert place.rows() == dict.fromkeys(DAYS[1:], 6)
    assert [r["day"] for r in quarantine(spark, place.lake).collect()] == [DAYS[0]]
    place.put("a.csv", place.day(0))
    place.drain()
    assert place.rows(RAW_SALES) == place.rows() == dict.fromkeys(DAYS, 6)
    assert quarantine(spark, place.lake).count() == 0
    place.drain()
    assert place.rows() == dict.fromkeys(DAYS, 6)


def test_a_replay_takes_quarantined_days_again(spark, place):
    place.put("a.csv", place.day(0) + place.day(1))
    strict = jobs.Limits(max_price=17_500)
    with pytest.raises(RulesBroken, match="raw 2022-01-31"):
        place.drain(limits=strict)
    assert place.rows() == {DAYS[0]: 6}
    assert replay_quarantine(spark, place.lake, strict) == []
    assert replay_quarantine(spark, place.lake) == [DAYS[1]]
    assert place.rows() == dict.fromkeys(DAYS[:2], 6)
    assert quarantine(spark, place.lake).count() == 0
    assert replay_quarantine(spark, place.lake) == []


def test_a_repaired_file_may_lose_a_day(spark, place):
    place.put("a.csv", place.day(0) + place.day(2))
    place.put("b.csv", place.day(3))
    place.drain()
    assert place.rows() == {DAYS[0]: 6, DAYS[2]: 6, DAYS[3]: 6}
    place.put("a.csv", place.day(2)[:4])
    place.drain()
    assert place.rows(RAW_SALES) == place.rows() == {DAYS[2]: 4, DAYS[3]: 6}
    months = read_layer(spark, place.lake.path(CURATED_EXPENSES)).select("mes").distinct().collect()
    assert [r[0] for r in months] == [dt.date(2022, 2, 1)]
    assert landed_sales(spark, place.lake).count() == 10


def test_a_bad_file_is_left_out_whole_and_named(spark, place):
    place.put("good.csv", place.day(0))
    place.put("bad.csv", [place.day(1)[0].replace("2022-01-31", "31 of January"), *place.day(1)[1:]])
    write_lines(place.folder / "short.csv", ["Date,Company", "2022-01-30,Ford"])
    with pytest.raises(SourceError, match="2 file.*left out") as raised:
        place.drain()
    assert "bad.csv" in str(raised.value) and "short.csv" in str(raised.value)
    assert place.rows() == {DAYS[0]: 6}
    reasons = {r["file"].rsplit("/")[-1]: r["reason"] for r in landed_files(spark, place.lake).collect()}
    assert reasons["good.csv"] is None and "1 row(s)" in reasons["bad.csv"]
    assert "columns missing" in reasons["short.csv"]
    place.drain()
    place.put("bad.csv", place.day(1))
    place.drain()
    assert place.rows() == dict.fromkeys(DAYS[:2], 6)


def test_rows_without_a_date_are_counted_per_file(spark, place):
    place.put("a.csv", [place.day(0)[0].replace("2022-01-30", ""), *place.day(0)[1:]])
    place.drain()
    line = landed_files(spark, place.lake).first()
    assert (line["n_rows"], line["n_undated"], line["n_unreadable"], line["reason"]) == (6, 1, 0, None)
    assert place.rows() == {DAYS[0]: 5}


def test_files_with_odd_names(spark, place):
    place.put("sales of, 100% ñ.csv", place.day(0))
    place.drain()
    assert place.rows() == {DAYS[0]: 6}


def test_a_new_checkpoint_lands_no_file_twice(spark, place):
    place.put("a.csv", place.day(0))
    place.put("b.csv", place.day(1))
    place.drain("one")
    before = place.content()
    number = landed_set(spark, place.lake).current().number
    place.drain("two")
    assert place.content() == before
    assert landed_set(spark, place.lake).current().number == number


@pytest.mark.parametrize("step", ["load_good_days", "curate_good_days", "_set_apart"])
def test_a_run_that_fails_after_landing_is_repeated_whole(spark, place, monkeypatch, step):
    place.put("a.csv", place.day(0) + place.day(1))
    with monkeypatch.context() as patch:
        patch.setattr(landing_module, step, lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(Exception, match="gone"):
            place.drain()
    place.drain()
    assert place.rows(RAW_SALES) == place.rows() == dict.fromkeys(DAYS[:2], 6)
    assert landed_files(spark, place.lake).count() == 1


def test_batches_are_compacted(spark, place):
    """Three files for one day leave three folders of it; compaction leaves one, with the same rows."""
    for n in range(3):
        place.put(f"{n}.csv", place.day(0)[2 * n : 2 * n + 2] + place.day(1)[2 * n : 2 * n + 2])
        place.drain()
    tables = landed_set(spark, place.lake)
    assert {len(t) for t in tables.current().tables["ventas"].parts.values()} == {3}
    rows = sorted(map(str, landed_sales(spark, place.lake).select("car_id", "file").collect()))
    assert compact_landing(spark, place.lake) == [str(d) for d in DAYS[:2]]
    assert {len(t) for t in tables.current().tables["ventas"].parts.values()} == {1}
    assert {len(t) for t in tables.current().tables["archivos"].parts.values()} == {1}
    assert sorted(map(str, landed_sales(spark, place.lake).select("car_id", "file").collect())) == rows
    place.put("0.csv", place.day(0)[:2])
    place.drain()
    assert place.rows() == {DAYS[0]: 6, DAYS[1]: 4}
