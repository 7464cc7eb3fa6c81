"""The queries behind a forecast dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.functions.dates import quarter_label, quarter_range

ALL_STORES = "All Stores"
FULL_FORECAST = "Full Forecast"


def choices(forecasts: DataFrame) -> DataFrame:
    """Values of the three selection lists, from one pass over the forecasts."""

    def item(kind, value):
        return F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("choice"))

    found = forecasts.select(
        F.inline(
            F.array(
                item("category", F.col("category_name")),
                item("quarter", quarter_label("Date")),
                item("store", F.col("store_number")),
            )
        )
    )
    spark = forecasts.sparkSession
    fixed = spark.createDataFrame(
        [("quarter", FULL_FORECAST), ("store", ALL_STORES)], "kind string, choice string"
    )
    return found.distinct().unionAll(fixed)


def selection(
    forecasts: DataFrame,
    category: str,
    store: int | str = ALL_STORES,
    quarter: str = FULL_FORECAST,
) -> DataFrame:
    """Rows of a category, optionally of one store and one quarter.

    All stores are not added up: every store's rows come back.
    """
    rows = forecasts.filter(F.col("category_name") == category)
    if store != ALL_STORES:
        rows = rows.filter(F.col("store_number") == int(store))
    if quarter != FULL_FORECAST:
        # as a range of dates, which reaches the scan
        first, last = (F.lit(day).cast("date") for day in quarter_range(quarter))
        rows = rows.filter(F.col("Date").between(first, last))
    return rows


def volume_series(forecasts: DataFrame, category: str, **options) -> DataFrame:
    rows = selection(forecasts, category, **options)
    return rows.select("store_number", "Date", "forecast_volume").orderBy("Date", "store_number")


def sales_series(forecasts: DataFrame, category: str, **options) -> DataFrame:
    rows = selection(forecasts, category, **options)
    return rows.select("store_number", "Date", "fc_sales").orderBy("Date", "store_number")
