"""Top slices. Every limit has an explicit tie-break, so results do not depend on order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.operators.filters import latest_year
from shelfweek.operators.rollups import yearly_totals
from shelfweek.sinks.files import settle


def head_rows(df: DataFrame, order: list[str], n: int = 6) -> DataFrame:
    return df.orderBy(*order).limit(n)


def _top_of_latest_year(weekly: DataFrame, by: str, n: int) -> DataFrame:
    # the yearly table is tiny, but its source is not: the year test goes on the rows,
    # where the scalar is a one-column scan, instead of on a second full aggregation
    dated = weekly.withColumn("_year", F.year("date"))
    recent = latest_year(dated, "_year").drop("_year")
    return (
        yearly_totals(recent, by)
        .orderBy(F.desc("total_yearly_sales"), F.asc_nulls_last(by))
        .limit(n)
    )


def top_categories(weekly: DataFrame, n: int = 3) -> DataFrame:
    """The n categories with the largest sales in the latest year."""
    return _top_of_latest_year(weekly, "category_name", n)


def _keep(rows: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """Rows whose value is among the names, a NULL matching a NULL. Spark sends the names to
    every executor if their size allows."""
    few = names.select(F.col(column).alias("_name"))
    return rows.join(few, F.col(column).eqNullSafe(F.col("_name")), "left_semi")


def in_top_categories(weekly: DataFrame, n: int = 3) -> DataFrame:
    return _keep(weekly, top_categories(weekly, n), "category_name")


def top_stores(weekly: DataFrame, categories: int = 3, stores: int = 5) -> DataFrame:
    """The stores with the largest latest-year sales within the top categories.

    Top categories have sales in the latest year, so theirs is the latest of all.
    """
    return _top_of_latest_year(in_top_categories(weekly, categories), "store_number", stores)


def top_slice(weekly: DataFrame, categories: int = 3, stores: int = 5) -> DataFrame:
    """All rows of the top stores within the top categories. Those categories' rows are
    settled: the latest year, the stores and the rows themselves are all taken from them."""
    kept = settle(in_top_categories(weekly, categories))
    names = _top_of_latest_year(kept, "store_number", stores)
    return _keep(kept, names, "store_number")


def top_series_by_peak(weekly: DataFrame, n: int = 50) -> DataFrame:
    """All rows of the n series with the largest single week."""
    peaks = (
        weekly.groupBy("srl_num")
        .agg(F.max("total_sales").alias("_peak"))
        .orderBy(F.desc("_peak"), "srl_num")
        .limit(n)
    )
    return _keep(weekly, peaks, "srl_num")
