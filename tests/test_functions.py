import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfweek.functions import dates, measures


def one(spark, column, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names))
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("08/28/2022", "2022-08-28"),
        ("8/8/2022", "2022-08-08"),
        ("02/29/2024", "2024-02-29"),
        ("02/30/2022", None),
        ("2022-08-28", None),
        ("", None),
        (None, None),
    ],
)
def test_us_dates(spark, text, expected):
    got = one(spark, dates.parse_us_date("s"), s=text)
    assert (got and got.isoformat()) == expected


def test_iso_dates(spark):
    assert one(spark, dates.parse_iso_date("s"), s="2022-08-28") == dt.date(2022, 8, 28)
    assert one(spark, dates.parse_iso_date("s"), s="2022-8-5") == dt.date(2022, 8, 5)
    assert one(spark, dates.parse_iso_date("s"), s="2022-13-05") is None
    assert one(spark, dates.parse_iso_date("s"), s="08/28/2022") is None


def test_week_starts_on_sunday_for_every_day_of_some_years(spark):
    days = spark.sql(
        "SELECT explode(sequence(date'2019-12-01', date'2024-03-10', interval 1 day)) AS d"
    ).select("d", dates.week_start("d").alias("w"))
    for d, w in days.collect():
        assert w == d - dt.timedelta((d.weekday() + 1) % 7)


def test_iso_week_is_not_the_sunday_week(spark):
    df = spark.sql("SELECT date'2022-01-01' AS d")
    row = df.select(dates.week_start("d").alias("w"), F.weekofyear("d").alias("n")).first()
    assert row["w"] == dt.date(2021, 12, 26) and row["n"] == 52


def test_calendar_columns(spark):
    df = spark.sql("SELECT date'2022-09-04' AS d").select(
        *[c.alias(n) for n, c in dates.calendar_columns("d").items()]
    )
    assert df.first().asDict() == {
        "year": 2022,
        "month": 9,
        "day_of_month": 4,
        "week_number": 35,
        "day_of_week": 1,
        "quarter": 3,
        "is_weekend": True,
    }


def test_quarter_label(spark):
    df = spark.sql("SELECT date'2022-08-28' AS d").select(dates.quarter_label("d"))
    assert df.first()[0] == "2022-Q3"


def test_leap_day_goes_back_to_the_28th(spark):
    df = spark.sql("SELECT date'2024-02-29' AS d").select(dates.years_before("d", 3))
    assert df.first()[0] == dt.date(2021, 2, 28)


def test_totals_skip_missing_values(spark):
    rows = [("a", float("nan")), ("a", 2.0), ("b", None), ("c", 0.1), ("c", 0.2)]
    df = spark.createDataFrame(rows, "k string, x double").groupBy("k")
    got = df.agg(measures.total("x").alias("t"), measures.total_or_zero("x").alias("z"))
    assert {r["k"]: (r["t"], r["z"]) for r in got.collect()} == {
        "a": (2.0, 2.0),
        "b": (None, 0.0),
        "c": (0.3, 0.3),
    }


def test_totals_do_not_depend_on_row_order(spark):
    values = [0.01 * (i % 997) + 1e6 * (i % 3) for i in range(5000)]
    sums = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
        sums.add(df.agg(measures.total("x")).first()[0])
    assert len(sums) == 1


@pytest.fixture
def without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield
    spark.conf.unset("spark.sql.ansi.enabled")


def test_large_totals_are_exact_without_ansi(spark, without_ansi):
    df = spark.createDataFrame([(8e14,)] * 3 + [(0.25,)], "x double")
    assert df.agg(measures.total("x")).first()[0] == 2.4e15 + 0.25
    down = spark.createDataFrame([(-8e14,)] * 3 + [(-0.75,)], "x double")
    assert down.agg(measures.total("x")).first()[0] == -2.4e15 - 0.75


@pytest.mark.parametrize("values", [[9e17] * 11, [2e18], [-2e18]])
def test_totals_that_do_not_fit_are_an_error(spark, without_ansi, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    with pytest.raises(Exception, match="too large"):
        df.agg(measures.total("x")).collect()


def test_fine_digits_count_and_infinities_do_not(spark):
    df = spark.createDataFrame([(0.000001,)] * 7 + [(float("inf"),), (-float("inf"),)], "x double")
    assert df.agg(measures.total("x")).first()[0] == 0.000007


def test_quarters_as_ranges():
    assert dates.quarter_range("2022-Q4") == ("2022-10-01", "2022-12-31")
    assert dates.quarter_range("2022-Q1") == ("2022-01-01", "2022-03-31")
    for bad in ("2022", "2022-Q5", "x-Q1"):
        with pytest.raises(ValueError):
            dates.quarter_range(bad)
