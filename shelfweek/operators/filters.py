"""Row selections. One-row limits come in as scalar subqueries, which Spark evaluates
before the scan and can push into it; nothing is pulled to the driver."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweek.functions import dates


def max_value(df: DataFrame, value: str | Column) -> Column:
    """Largest value of a column as a scalar subquery."""
    c = F.col(value) if isinstance(value, str) else value
    return df.agg(F.max(c)).scalar()


def trailing_years(
    df: DataFrame,
    years: int = 3,
    date: str | Column = "date_parsed",
    newest: Column | None = None,
) -> DataFrame:
    """Rows no older than ``years`` before the newest date, that day included; ``newest`` may
    pass that date as a scalar found elsewhere."""
    d = F.col(date) if isinstance(date, str) else date
    newest = max_value(df, d) if newest is None else newest
    return df.filter(d >= dates.years_before(newest, years))


def category_ids(df: DataFrame, category_name: str) -> DataFrame:
    """Ids under which a category name occurs."""
    return df.filter(F.col("category_name") == category_name).select("category").distinct()


def with_category_ids(df: DataFrame, category_name: str) -> DataFrame:
    """Rows whose category id belongs to the name, however many ids it has."""
    return df.join(category_ids(df, category_name), "category", "left_semi")


def category_window(
    df: DataFrame,
    category_name: str,
    start: str | Date,
    end: str | Date,
    year: int | None = None,
    date: str = "date",
) -> DataFrame:
    """One category within a closed date range, and optionally within one year.

    A category id test as well would change nothing here: the ids are those of the very
    rows that carry the name. ``with_category_ids`` is for lines found by id alone. A column
    ``year`` is used where there is one, so that folders by year are skipped.
    """
    d = F.col(date)
    keep = (
        d.between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
        & (F.col("category_name") == category_name)
        & F.col("category").isNotNull()
    )
    if year is not None:
        years = F.col("year") if "year" in df.columns else F.year(d)
        keep = keep & (years == year)
    return df.filter(keep)


def latest_year(df: DataFrame, year: str = "year") -> DataFrame:
    return df.filter(F.col(year) == max_value(df, year))


def at_last_date(df: DataFrame, date: str = "date") -> DataFrame:
    return df.filter(F.col(date) == max_value(df, date))
