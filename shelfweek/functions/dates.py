"""Date parsing and calendar columns. Weeks start on Sunday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_us_date(c: str | Column) -> Column:
    """Month/day/year text, padded or not, to a date; NULL where it is no date."""
    return F.try_to_date(_col(c), "M/d/yyyy")


def parse_iso_date(c: str | Column) -> Column:
    """Year-month-day text, padded or not, to a date; NULL where it is no date."""
    return F.try_to_date(_col(c), "yyyy-M-d")


def week_start(c: str | Column) -> Column:
    """The Sunday on or before the date (``date_trunc('week')`` gives Mondays)."""
    # names the date once, so an expression that parses text is evaluated once
    return F.next_day(F.date_sub(_col(c), 7), "SUN")


def quarter_label(c: str | Column) -> Column:
    """``2022-Q3``"""
    d = _col(c)
    return F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))


def years_before(c: str | Column, years: int) -> Column:
    """Same calendar day some years earlier; 29 February falls to the 28th."""
    return F.add_months(_col(c), -12 * years)


def calendar_columns(date: str | Column) -> dict[str, Column]:
    """Calendar parts of a parsed date, ``week_number`` being the ISO week."""
    d = _col(date)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day_of_month": F.dayofmonth(d),
        "week_number": F.weekofyear(d),
        "day_of_week": F.dayofweek(d),
        "quarter": F.quarter(d),
        "is_weekend": F.dayofweek(d).isin(1, 7),
    }


def check_horizon(horizon: int) -> int:
    if horizon < 1:
        raise ValueError(f"a forecast needs a horizon of 1 or more, not {horizon}")
    return horizon


def quarter_range(label: str) -> tuple[str, str]:
    """First and last day of a quarter such as ``2022-Q3``, as ISO dates."""
    year, _, quarter = label.partition("-Q")
    if not (year.isdigit() and quarter in ("1", "2", "3", "4")):
        raise ValueError(f"a quarter reads like 2022-Q3, not {label!r}")
    last = {"1": "03-31", "2": "06-30", "3": "09-30", "4": "12-31"}[quarter]
    return f"{int(year):04d}-{3 * int(quarter) - 2:02d}-01", f"{int(year):04d}-{last}"


def weekly_dates(start: Column, count: int) -> Column:
    """``count`` dates a week apart, the first being ``start`` itself."""
    check_horizon(count)
    return F.sequence(start, F.date_add(start, 7 * (count - 1)), F.expr("interval 7 days"))
