"""The stages end to end: raw lines, trailing window, weekly series, forecasts."""

from __future__ import annotations

from datetime import date as Date
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweek.functions import dates
from shelfweek.operators import arima, ranking, rollups, series
from shelfweek.operators.columns import add_calendar
from shelfweek.operators.filters import trailing_years
from shelfweek.sinks.files import replace_weeks, settle, write_weekly_sums


def recent_sales(sales: DataFrame, years: int = 3, newest: Column | None = None) -> DataFrame:
    """Lines of the trailing years with calendar columns."""
    return trailing_years(add_calendar(sales), years, "date_parsed", newest)


def weekly_sums(sales: DataFrame, date: str = "date", parsed: bool = False) -> DataFrame:
    """Weekly sums, settled: the sales lines are read once, all that follows reads these."""
    return settle(rollups.weekly_sales(sales, date, parsed))


def build_weekly_sums(
    sales: DataFrame, path: str, date: str = "date", parsed: bool = False
) -> None:
    """Weekly sums of all lines, stored in a folder per week."""
    write_weekly_sums(rollups.weekly_sales(sales, date, parsed), path)


def refresh_weekly_sums(
    sales: DataFrame, new: DataFrame, path: str, date: str = "date", parsed: bool = False
) -> list[Date]:
    """Bring stored sums up to date with ``new`` lines, which ``sales`` holds as well: the weeks
    that new lines fall in are summed up again from all their lines, and only their folders are
    written. Running it twice changes nothing. Returns the weeks."""

    def day():
        return F.col(date) if parsed else dates.parse_us_date(date)

    # one row for each calendar week
    found = new.select(dates.week_start(day()).alias("week")).distinct().collect()
    weeks = sorted(r["week"] for r in found if r["week"])
    if not weeks:
        return []
    first, last = weeks[0], weeks[-1] + timedelta(6)
    lines = sales.filter(day().between(F.lit(first), F.lit(last)))
    if "year" in sales.columns:
        # folders by year are skipped
        lines = lines.filter(F.col("year").between(first.year, last.year))
    lines = lines.filter(dates.week_start(day()).isin(weeks))
    replace_weeks(rollups.weekly_sales(lines, date, parsed), path)
    return weeks


def numbered_sums(sums: DataFrame, fill_gaps: bool = False) -> DataFrame:
    """Stored weekly sums to the weekly relation: active series, numbered."""
    weekly = series.active_series(sums)
    if fill_gaps:
        weekly = series.fill_gaps(weekly)
    return series.number_series(weekly)


def active_weekly(sales: DataFrame, date: str = "date", parsed: bool = False) -> DataFrame:
    """Weekly sums of the series that sold in the last week, which the settled sums tell."""
    return series.active_series(weekly_sums(sales, date, parsed))


def weekly_relation(
    sales: DataFrame, fill_gaps: bool = False, date: str = "date", parsed: bool = False
) -> DataFrame:
    """Weekly sums of the active series, numbered."""
    return numbered_sums(weekly_sums(sales, date, parsed), fill_gaps)


def forecast_top_slice(
    weekly: DataFrame, categories: int = 3, stores: int = 5, horizon: int = 18
) -> DataFrame:
    """Forecast both measures for the top stores within the top categories."""
    return arima.forecast_weekly(ranking.top_slice(weekly, categories, stores), horizon)


def forecast_top_series(weekly: DataFrame, n: int = 50, horizon: int = 18) -> DataFrame:
    """Forecast both measures for the n series with the largest single week."""
    return arima.forecast_weekly(ranking.top_series_by_peak(weekly, n), horizon)
