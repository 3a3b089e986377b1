import datetime as dt

import pytest
from conftest import gap_csv_lines, shared_csv_lines, write_lines
from pyspark.sql import functions as F

from saldero.sources.errors import SourceError, SourceNotFound
from saldero.sources.sales import (
    PII_COLUMNS,
    SourceProfile,
    choose_csv,
    load_source,
    prepare_sales,
    profile_source,
)


def test_load_drops_personal_data_and_types_columns(spark, shared_sales):
    assert not set(PII_COLUMNS) & set(shared_sales.columns)
    assert dict(shared_sales.dtypes) == {
        "car_id": "string",
        "date": "date",
        "dealer_name": "string",
        "company": "string",
        "model": "string",
        "price": "double",
        "dealer_region": "string",
    }
    assert shared_sales.count() == 24


def test_personal_data_never_leaves_the_scan(shared_sales):
    plan = shared_sales._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema") :]
    assert "Phone" not in schema and "Income" not in schema


def test_missing_columns_are_named_in_order(spark, tmp_path):
    path = write_lines(tmp_path / "bad.csv", ["Date", "2022-01-01"])
    with pytest.raises(SourceError, match=r"\['company', 'dealer_name', 'model', 'price'\]"):
        load_source(spark, path)


def test_integer_ids_lose_padding_and_text_ids_keep_it(spark, tmp_path):
    lines = gap_csv_lines()
    lines[1] = lines[1].replace("1,", "007,", 1)
    found = load_source(spark, write_lines(tmp_path / "a.csv", lines))
    assert sorted(r.car_id for r in found.collect()) == ["2", "3", "4", "7"]
    lines[2] = lines[2].replace("2,", "x2,", 1)
    found = load_source(spark, write_lines(tmp_path / "b.csv", lines))
    assert sorted(r.car_id for r in found.collect()) == ["007", "3", "4", "x2"]


@pytest.mark.parametrize("text", ["1/5/2022", "01/05/2022", "2022-01-05", "2022/1/5", "20220105"])
def test_one_date_format_per_load(spark, tmp_path, text):
    lines = gap_csv_lines()[:1] + [f"1,{text},x,M,A,Ford,m1,100,1", "2,,x,M,A,Ford,m1,100,1"]
    found = load_source(spark, write_lines(tmp_path / "a.csv", lines)).collect()
    assert sorted((r.date for r in found), key=str) == [dt.date(2022, 1, 5), None]


@pytest.mark.parametrize("text", ["not a date", "2022-02-30", "5/1/2022"])
def test_unreadable_or_mixed_dates_fail_the_load(spark, tmp_path, text):
    lines = gap_csv_lines() + [f"9,{text},x,M,A,Ford,m1,100,1"]
    with pytest.raises(SourceError, match="date format"):
        load_source(spark, write_lines(tmp_path / "a.csv", lines))


def test_known_profile_skips_the_pass_but_still_rejects_bad_dates(spark, tmp_path):
    lines = gap_csv_lines() + ["9,nonsense,x,M,A,Ford,m1,100,1"]
    found = load_source(
        spark, write_lines(tmp_path / "a.csv", lines), SourceProfile("yyyy-MM-dd")
    )
    with pytest.raises(Exception, match="unreadable sale date"):
        found.collect()


def test_text_prices_stay_text(spark, tmp_path):
    lines = gap_csv_lines() + ["9,2022-01-04,x,M,A,Ford,m1,cheap,1"]
    found = load_source(spark, write_lines(tmp_path / "a.csv", lines))
    assert dict(found.dtypes)["price"] == "string"


def test_missing_tokens_and_quotes(spark, tmp_path):
    lines = gap_csv_lines()[:1] + [
        '1,2022-01-05,x,M,"Smith, ""J"" & Co",NA,n/a,100,1',
        "2,2022-01-05,x,M, A ,None,null,,1",
    ]
    rows = load_source(spark, write_lines(tmp_path / "a.csv", lines)).orderBy("car_id").collect()
    assert [(r.dealer_name, r.company, r.model, r.price) for r in rows] == [
        ('Smith, "J" & Co', None, None, 100.0),
        (" A ", None, None, None),
    ]


def test_choosing_a_csv(spark, tmp_path):
    one = tmp_path / "one"
    write_lines(one / "deep" / "sales 2022.csv", shared_csv_lines())
    assert load_source(spark, choose_csv(spark, str(one))).count() == 24

    two = tmp_path / "two"
    write_lines(two / "x" / "a.csv", shared_csv_lines())
    write_lines(two / "y" / "b.csv", shared_csv_lines())
    with pytest.raises(SourceError, match=r"a\.csv.*b\.csv"):
        choose_csv(spark, str(two))
    assert choose_csv(spark, str(two), "b.csv").endswith("/y/b.csv")
    with pytest.raises(SourceNotFound, match=r"c\.csv.*a\.csv.*b\.csv"):
        choose_csv(spark, str(two), "c.csv")

    empty = tmp_path / "empty"
    write_lines(empty / "readme.txt", ["nothing"])
    with pytest.raises(SourceNotFound):
        choose_csv(spark, str(empty))
    with pytest.raises(SourceNotFound):
        choose_csv(spark, str(tmp_path / "absent"))


def test_prepare_typed_frame(spark):
    frame = spark.createDataFrame(
        [(7, dt.datetime(2022, 1, 5, 13, 0), "A", "Ford", "m", float("nan"), "555")],
        "`Car_id` int, Date timestamp, Dealer_Name string, Company string, Model string, "
        "`Price ($)` double, Phone string",
    )
    row = prepare_sales(frame).first()
    assert (row.car_id, row.date, row.price) == ("7", dt.date(2022, 1, 5), None)
    assert "phone" not in row.asDict()
    whole = frame.withColumn("Price ($)", F.lit(100))
    assert dict(prepare_sales(whole).dtypes)["price"] == "double"
    text = frame.withColumn("Price ($)", F.lit("cheap"))
    assert dict(prepare_sales(text).dtypes)["price"] == "string"


def test_extra_columns_pass_through(spark, tmp_path):
    lines = [gap_csv_lines()[0] + ",Colour"] + [x + ",red" for x in gap_csv_lines()[1:]]
    found = load_source(spark, write_lines(tmp_path / "a.csv", lines))
    assert found.where(F.col("colour") == "red").count() == 4


def dated(tmp_path, *texts):
    lines = gap_csv_lines()[:1]
    return write_lines(tmp_path / "a.csv", lines + [f'{i},"{x}",x,M,A,Ford,m1,100,1' for i, x in enumerate(texts)])


@pytest.mark.parametrize(
    "texts, day",
    [
        (["January 5, 2022"], dt.date(2022, 1, 5)),
        (["jan 5, 2022", "JAN 5, 2022"], dt.date(2022, 1, 5)),
        (["5 Sept. 2021"], dt.date(2021, 9, 5)),
        (["May 5 2022", "May 5 2022"], dt.date(2022, 5, 5)),
        (["Wednesday, 5 January 2022"], dt.date(2022, 1, 5)),
        (["5.1.2022", "25.1.2022"], dt.date(2022, 1, 5)),
        (["2022.01.05"], dt.date(2022, 1, 5)),
        (["13/01/69", "05/01/69"], dt.date(1969, 1, 5)),
        (["05-01-22", "31-01-22"], dt.date(2022, 1, 5)),
        (["22-01-05", "33-01-31"], dt.date(2022, 1, 5)),
        (["5-Jan-22"], dt.date(2022, 1, 5)),
        (["45-Jan-05"], dt.date(2045, 1, 5)),
        (["2022-01-05T23:59:59+02:00", "2022-01-05T00:00:00Z"], dt.date(2022, 1, 5)),
        (["2022-01-05 23:59:59.123456 -0500", "2022-01-05"], dt.date(2022, 1, 5)),
        (["1/5/2022 11:30 PM", "1/13/2022 1:30 a.m."], dt.date(2022, 1, 5)),
        (["20220105"], dt.date(2022, 1, 5)),
        (["2022-31-12", "2022-05-01"], dt.date(2022, 1, 5)),
        (["  2022-01-05 "], dt.date(2022, 1, 5)),
    ],
)
def test_dates_are_read_by_their_shape(spark, tmp_path, texts, day):
    found = {r.date for r in load_source(spark, dated(tmp_path, *texts)).collect()}
    assert day in found and None not in found


@pytest.mark.parametrize(
    "texts",
    [
        ["January 5, 2022", "2022-01-05"],
        ["5.1.2022", "5/1/2022"],
        ["32/13/2022"],
        ["5 Janvier 2022"],
        ["2022-01-05", "2022-01-05 25 o'clock"],
        ["13/01/2022", "01/13/2022"],
        ["5/2022/1"],
        ["202201051"],
        ["February 30, 2022"],
        ["1/5/2022 and more"],
    ],
)
def test_loads_of_no_single_form_are_refused_with_their_shapes(spark, tmp_path, texts):
    with pytest.raises(SourceError, match="no single date format.*as in"):
        load_source(spark, dated(tmp_path, *texts))


@pytest.mark.parametrize(
    "texts, orders",
    [
        (["1/5/2022", "12/12/2022"], "mdy or dmy"),
        (["01.05.22", "03.04.05"], "mdy or dmy or ymd"),
        (["05-Jan-22"], "dmy or ymd"),
    ],
)
def test_an_ambiguous_load_is_refused_with_its_evidence(spark, tmp_path, texts, orders):
    path = dated(tmp_path, *texts)
    with pytest.raises(SourceError, match=f"{orders}.*as in"):
        load_source(spark, path, refuse_ambiguous=True)
    assert load_source(spark, path).count() == len(texts)
    decided = load_source(spark, dated(tmp_path, "13/1/2022", "1/5/2022"), refuse_ambiguous=True)
    assert {r.date for r in decided.collect()} == {dt.date(2022, 1, 13), dt.date(2022, 5, 1)}


def test_very_many_shapes_are_refused_without_collecting_them(spark, tmp_path):
    texts = ["2022-01-05"] * 3 + ["-" * n + "1" for n in range(60)]
    with pytest.raises(SourceError, match="among its shapes.*2022-01-05"):
        load_source(spark, dated(tmp_path, *texts))


def test_a_load_without_dates_has_none(spark, tmp_path):
    assert [r.date for r in load_source(spark, dated(tmp_path, "")).collect()] == [None]


def test_a_profile_reads_its_rows_once(spark):
    """Shapes and orders are found from each text of a date, with the number of its rows."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [(f"{1 + n % 12}/{1 + n % 28}/2022", "1.5" if n % 3 else "x", str(n)) for n in range(300)]
    rows += [(None, None, "7")]
    text = spark.createDataFrame(rows, "date string, price string, car_id string")
    found = profile_source(text.mapInArrow(counted, text.schema))
    assert (found.date_format.order, found.numeric_price, found.integer_ids) == ("mdy", False, True)
    assert read.value == len(rows)
    wrong = text.where("date IS NOT NULL").withColumn("date", F.lit("1/2/x"))
    with pytest.raises(SourceError, match=r"\(300, as in"):
        profile_source(wrong)
