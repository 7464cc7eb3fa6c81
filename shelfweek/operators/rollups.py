"""Grouped sums and profiles. Each is one partial and final aggregation, so a group
holding much of the data is reduced where it is read before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfweek.functions import dates
from shelfweek.functions.measures import total, total_or_zero


def daily_sales(sales: DataFrame) -> DataFrame:
    """Sums per store, text date and category."""
    return sales.groupBy("store_number", "date", "category_name").agg(
        total("sale_dollars").alias("total_sales"),
        total("volume_sold_liters").alias("total_volume_sold"),
    )


def weekly_sales(sales: DataFrame, date: str = "date", parsed: bool = False) -> DataFrame:
    """Sums per store, Sunday week and category, straight from the sales lines.

    Sums compose, so the daily step in between is left out. Lines without a readable
    date are dropped; ``date_audit`` counts them. They are dropped after the sums, by a
    count rather than by the key: a test of the key would move below the aggregation, and
    every date would be parsed twice.
    """
    day = F.col(date) if parsed else dates.parse_us_date(date)
    lines = sales.select(
        "store_number",
        dates.week_start(day).alias("date"),
        "category_name",
        "sale_dollars",
        "volume_sold_liters",
    )
    sums = lines.groupBy("store_number", "date", "category_name").agg(
        total_or_zero("sale_dollars").alias("total_sales"),
        total_or_zero("volume_sold_liters").alias("total_volume_sold"),
        F.count("date").alias("_dated"),
    )
    return sums.filter(F.col("_dated") > 0).drop("_dated")


def store_day_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy("store_number", "date").agg(total("sale_dollars").alias("total_sales"))


def year_profile(sales: DataFrame, date: str = "date") -> DataFrame:
    """First and last date and number of lines per year, newest year first."""
    parsed = sales.select(dates.parse_us_date(date).alias("date_parsed"))
    return (
        parsed.groupBy(F.year("date_parsed").alias("year"))
        .agg(
            F.min("date_parsed").alias("min_date"),
            F.max("date_parsed").alias("max_date"),
            F.count("*").alias("row_count"),
        )
        .orderBy(F.desc("year"))
    )


def category_year_summary(sales: DataFrame) -> DataFrame:
    """Yearly sums per category, newest year and largest sales first."""
    return (
        sales.groupBy("category", "category_name", "year")
        .agg(
            total_or_zero("sale_dollars").alias("total_sales_dollars"),
            total_or_zero("volume_sold_liters").alias("total_volume_sold_liters"),
        )
        .orderBy(F.desc("year"), F.desc("total_sales_dollars"))
    )


def yearly_totals(weekly: DataFrame, by: str) -> DataFrame:
    """Yearly sums of a weekly relation by category or by store."""
    return weekly.groupBy(F.year("date").alias("year"), by).agg(
        total_or_zero("total_sales").alias("total_yearly_sales"),
        total_or_zero("total_volume_sold").alias("total_yearly_volumes"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def distinct_counts(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Number of distinct values per column, NULL counting as one value.

    The rows are first reduced to distinct combinations, so that the expansion Spark
    does for several distinct counts works on the small relation.
    """
    combos = df.groupBy(*columns).agg(F.count("*").alias("rows_in_combo"))
    return combos.agg(
        *[
            (F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(name)
            for c, name in columns.items()
        ],
        F.sum("rows_in_combo").alias("row_count"),
    )


def distinct_bitmaps(df: DataFrame, columns: list[str], by: Column) -> DataFrame:
    """What tells distinct values apart, per period ``by``, such that periods can be merged:
    whole numbers as bits of bitmaps, each of a bucket of 32,768; texts and NULL as rows of
    their own. A period's rows are read once, and never again."""

    def mark(name):
        value, whole = F.col(name), isinstance(df.schema[name].dataType, T.IntegralType)
        number = value.cast("long") if whole else F.lit(None).cast("long")
        return F.struct(
            F.lit(name).alias("column_name"),
            F.bitmap_bucket_number(number).alias("bucket"),
            F.bitmap_bit_position(number).alias("_bit"),
            (F.lit(None) if whole else value).cast("string").alias("text"),
        )

    marks = df.select(by.alias("period"), F.inline(F.array(*[mark(c) for c in columns])))
    return marks.groupBy("period", "column_name", "bucket", "text").agg(
        F.bitmap_construct_agg("_bit").alias("bits"), F.count("*").alias("row_count")
    )


def merged_counts(bitmaps: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Distinct counts over all periods of ``distinct_bitmaps``, as ``distinct_counts`` of the
    rows themselves would give them."""
    merged = bitmaps.groupBy("column_name", "bucket", "text").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.sum("row_count").alias("row_count")
    )
    values = F.when(F.col("bucket").isNull(), 1).otherwise(F.bitmap_count("bits"))
    whose = {c: F.col("column_name") == c for c in columns}
    counts = [
        F.coalesce(F.sum(F.when(whose[c], values)), F.lit(0)).alias(name)
        for c, name in columns.items()
    ]
    rows = F.sum(F.when(whose[next(iter(columns))], F.col("row_count")))
    return merged.agg(*counts, rows.alias("row_count"))


def series_profile(weekly: DataFrame) -> DataFrame:
    return distinct_counts(
        weekly,
        {"srl_num": "n_series", "store_number": "n_stores", "category_name": "n_categories"},
    )


def rows_per_category(weekly: DataFrame) -> DataFrame:
    return (
        weekly.groupBy("category_name")
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("row_count"), F.asc_nulls_last("category_name"))
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))
