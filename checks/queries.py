"""One query per operator, each over the whole tables.

Summaries use the supplier as store; forecasts use the supplier's nation, whose series
are denser.
"""

from __future__ import annotations

import os
from functools import partial
from unittest.mock import patch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfweek.functions import dates
from shelfweek.operators import (
    arima,
    backtest,
    columns,
    dashboard,
    filters,
    ranking,
    rollups,
    seasonal_arima,
    series,
    simple_forecast,
)
from shelfweek.plans import stages
from shelfweek.schemas import SALES_RAW, SERIES_KEYS, TARGETS
from shelfweek.sinks.files import (
    scratch_path,
    settle,
    write_dataset,
    write_forecasts,
    write_models,
    write_sales_small,
    write_weekly_table,
)
from shelfweek.sources import files
from shelfweek.sources.star_schema import sales_lines

# fixed values of the category window
CATEGORY = "PROMO"
WINDOW = ("1998-01-01", "1998-03-31")
YEAR = 1998


def _weekly(spark, folder, store="supplier", **kw):
    return stages.weekly_relation(sales_lines(spark, folder, store), **kw)


def _with_year(sales: DataFrame) -> DataFrame:
    return sales.withColumn("year", F.year(dates.parse_us_date("date")))


# columns and dates


def calendar_features(spark, folder):
    return columns.add_calendar(sales_lines(spark, folder))


def parse_dates(spark, folder):
    sales = sales_lines(spark, folder)
    lines = sales.groupBy("date").agg(F.count("*").alias("row_count"))
    return lines.withColumn("date_parsed", dates.parse_us_date("date"))


def date_audit(spark, folder):
    return columns.date_audit(sales_lines(spark, folder))


def value_audit(spark, folder):
    sales = sales_lines(spark, folder)
    texts = sales.select(*[F.col(c).cast("string").alias(c) for c in sales.columns])
    return columns.value_audit(texts, SALES_RAW)


def _csv_folder(spark, folder) -> str:
    """The sales lines as CSV files of two column orders, with values that cannot be read and
    lines that end after two fields, by rules on the quantity."""
    sales, quantity = sales_lines(spark, folder), F.col("volume_sold_liters")
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sales.columns}
    for column, of, text in (("sale_dollars", 9, "n/a"), ("date", 11, "13/45/1999"), ("store_number", 12, "")):
        texts[column] = F.when(quantity == of, text).otherwise(texts[column])
    ends = (F.col("category_name") == "PROMO") & (quantity == 7)
    path = scratch_path(spark)
    for names, half in ((sales.columns, quantity < 25), (sales.columns[::-1], quantity >= 25)):
        parts = [texts[c] for c in names]
        line = F.when(ends, F.concat_ws(",", *parts[:2])).otherwise(F.concat_ws(",", *parts))
        lines = sales.filter(half).select(line.alias(",".join(names)))
        # one column to the writer, which leaves commas alone
        lines.write.mode("append").option("header", True).option("sep", "\u0001").csv(path)
    return path


def csv_audit(spark, folder):
    texts = files.read_texts(spark, _csv_folder(spark, folder), SALES_RAW)
    return columns.value_audit(texts, SALES_RAW, broken=files.BROKEN)


def sales_from_csv(spark, folder):
    """All sales lines, written as CSV and read back from the paths of the environment."""
    path = scratch_path(spark)
    write_dataset(sales_lines(spark, folder), path, "csv")
    parent, name = path.rsplit("/", 1)
    with patch.dict(os.environ, DATASET_PATH=parent, DATASET_NAME=name):
        return files.read_sales(spark, name="sales_from_csv", fail_on_bad=True)


def sales_small_stored(spark, folder):
    """The trailing window as stored by year, read back."""
    path = scratch_path(spark)
    write_sales_small(stages.recent_sales(sales_lines(spark, folder)), path)
    return files.read_sales_small(spark, path)


def weekly_from_csv(spark, folder):
    path = scratch_path(spark)
    write_dataset(_weekly(spark, folder), path, "csv")
    return files.read_weekly(spark, path, "csv", name="weekly_from_csv")


def weekly_row_names(spark, folder):
    """Weekly rows of files that have numbers of rows in a first column, which is not kept."""
    path = scratch_path(spark)
    weekly = _weekly(spark, folder)
    names = F.monotonically_increasing_id().alias("row_name")
    write_dataset(weekly.select(names, *reversed(weekly.columns)), path, "csv")
    return files.read_weekly(spark, path, "csv", name="weekly_row_names")


def lowered_names(spark, folder):
    """Lines per series of sales whose columns are named in capitals."""
    sales = sales_lines(spark, folder)
    lowered = columns.lower_names(sales.toDF(*[c.upper() for c in sales.columns]))
    return lowered.groupBy(*series.PAIR).agg(F.count("*").alias("row_count"))


def column_listing(spark, folder):
    sales = columns.add_calendar(sales_lines(spark, folder))
    return sales.groupBy(F.lit(columns.column_list(sales)).alias("column_list")).agg(
        F.count("date_parsed").alias("dated_rows")
    )


def iso_dates(spark, folder):
    """Lines per date of sales with year-month-day texts; those without zeros too."""
    day = dates.parse_us_date("date")
    short = F.concat_ws("-", F.year(day), F.month(day), F.day(day))
    texts = F.when(F.month(day) < 7, day.cast("string")).otherwise(short)
    sales = columns.replace_text_date(sales_lines(spark, folder).withColumn("date", texts), iso=True)
    return sales.groupBy("date").agg(F.count("*").alias("row_count"))


def week_start(spark, folder):
    sales = sales_lines(spark, folder).groupBy("date").agg(F.count("*").alias("row_count"))
    return columns.add_week(columns.replace_text_date(sales))


def quarter_label(spark, folder):
    sales = columns.replace_text_date(sales_lines(spark, folder).select("date"))
    return (
        columns.add_quarter(sales, "date", "quarter_label")
        .groupBy("quarter_label")
        .agg(F.count("*").alias("row_count"))
    )


# filters


def last_3_years(spark, folder):
    return stages.recent_sales(sales_lines(spark, folder))


def filter_category_window(spark, folder):
    sales = columns.replace_text_date(sales_lines(spark, folder))
    dated = sales.withColumn("year", F.year("date"))
    return filters.category_window(dated, CATEGORY, *WINDOW, year=YEAR)


def category_id_lookup(spark, folder):
    sales = sales_lines(spark, folder)
    found = filters.with_category_ids(sales, CATEGORY)
    return found.groupBy("category", "category_name").agg(F.count("*").alias("row_count"))


def last_date_rows(spark, folder):
    return filters.at_last_date(rollups.weekly_sales(sales_lines(spark, folder)))


def active_series(spark, folder):
    return stages.active_weekly(sales_lines(spark, folder))


def weekly_refresh(spark, folder):
    """Stored weekly sums that lack some weeks and late lines, brought up to date."""
    sales, path = columns.replace_text_date(sales_lines(spark, folder)), scratch_path(spark)
    late = (F.col("date") >= "2000-01-01") | (F.col("category_name") == CATEGORY) & (F.year("date") == 1996)
    stages.build_weekly_sums(sales.filter(~late), path, parsed=True)
    stages.refresh_weekly_sums(sales, sales.filter(late), path, parsed=True)
    return files.read_weekly_sums(spark, path)


def stored_limits(spark, folder):
    path = scratch_path(spark)
    rollups.weekly_sales(sales_lines(spark, folder)).write.parquet(path)
    return files.stored_limits(spark, path)


def active_series_bucketed(spark, folder):
    """Active series of a table bucketed by series, without a shuffle; the last week comes from
    the footers of its files."""
    path = scratch_path(spark)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    write_weekly_table(rollups.weekly_sales(sales_lines(spark, folder)), table, 8, path)
    last = files.stored_limits(spark, path).first()["last"]
    return series.active_series(spark.table(table), F.lit(last))


def active_series_join(spark, folder):
    return series.active_series_by_join(rollups.weekly_sales(sales_lines(spark, folder)))


def gap_fill(spark, folder):
    return _weekly(spark, folder, "nation", fill_gaps=True)


# sums and profiles


def daily_sales(spark, folder):
    return rollups.daily_sales(sales_lines(spark, folder))


def weekly_sales(spark, folder):
    return rollups.weekly_sales(sales_lines(spark, folder))


def store_day_sales(spark, folder):
    return rollups.store_day_sales(sales_lines(spark, folder))


def year_profile(spark, folder):
    return rollups.year_profile(sales_lines(spark, folder))


def category_year_summary(spark, folder):
    return rollups.category_year_summary(_with_year(sales_lines(spark, folder)))


def yearly_by_category(spark, folder):
    return rollups.yearly_totals(stages.active_weekly(sales_lines(spark, folder)), "category_name")


def yearly_by_store(spark, folder):
    weekly = _weekly(spark, folder)
    return rollups.yearly_totals(ranking.in_top_categories(weekly), "store_number")


def max_date(spark, folder):
    newest = F.max(dates.parse_us_date("date"))
    return sales_lines(spark, folder).agg(
        newest.alias("max_date"), F.year(newest).alias("max_year")
    )


def row_count(spark, folder):
    return rollups.row_count(filter_category_window(spark, folder))


def distinct_stores(spark, folder):
    return rollups.distinct_values(sales_lines(spark, folder), "store_number")


def distinct_categories(spark, folder):
    return rollups.distinct_values(sales_lines(spark, folder), "category_name")


def distinct_counts(spark, folder):
    return rollups.distinct_counts(
        sales_lines(spark, folder),
        {"store_number": "n_stores", "category_name": "n_categories"},
    )


def series_profile(spark, folder):
    return rollups.series_profile(_weekly(spark, folder))


def series_profile_bitmaps(spark, folder):
    """The profile from bitmaps stored per year, those of the last years made later."""
    weekly, counts = _weekly(spark, folder), {
        "srl_num": "n_series",
        "store_number": "n_stores",
        "category_name": "n_categories",
    }
    year = F.year("date")
    stored = [
        settle(rollups.distinct_bitmaps(weekly.filter(part), list(counts), year))
        for part in (year < 2000, year >= 2000)
    ]
    return rollups.merged_counts(stored[0].union(stored[1]), counts)


def rows_per_category(spark, folder):
    return rollups.rows_per_category(stages.active_weekly(sales_lines(spark, folder)))


# series


def series_number(spark, folder):
    return _weekly(spark, folder)


def all_series_numbers(spark, folder):
    return series.series_numbers(sales_lines(spark, folder).select(*series.PAIR))


def series_positions(spark, folder):
    return series.positions(_weekly(spark, folder, "nation"), SERIES_KEYS).select(
        *SERIES_KEYS, "date", "position", "last_date"
    )


def nested_series(spark, folder):
    weekly = _weekly(spark, folder, "nation")
    rows = ["date", "total_sales", "total_volume_sold"]
    nested = series.nest(weekly, SERIES_KEYS, rows)
    return nested.select(
        *SERIES_KEYS,
        F.size("data").alias("weeks"),
        F.get("data", F.lit(0))["date"].alias("first_date"),
        F.array_max(F.col("data.total_sales")).alias("peak_sales"),
        F.element_at("data", -1)["total_volume_sold"].alias("last_volume"),
        # all nested rows, in order
        F.md5(
            F.array_join(
                F.transform(
                    "data",
                    lambda r: F.concat_ws(
                        " ",
                        r["date"].cast("string"),
                        r["total_sales"].cast("decimal(18,2)").cast("string"),
                        r["total_volume_sold"].cast("decimal(18,2)").cast("string"),
                    ),
                ),
                ",",
            )
        ).alias("rows_md5"),
    )


def grouped_apply(spark, folder):
    """The linear trend of each series of three weeks or more."""
    weekly = stages.active_weekly(sales_lines(spark, folder, "nation"))
    trend = series.positions(weekly, series.PAIR).groupBy(*series.PAIR).agg(
        F.round(F.regr_slope("total_volume_sold", "position"), 4).alias("slope"),
        F.round(F.regr_intercept("total_volume_sold", "position"), 4).alias("start"),
        F.max("position").alias("weeks"),
    )
    return trend.filter("weeks >= 3").drop("weeks")


def spread_series(spark, folder):
    """Weeks of each series, and in how many tasks they are after the rows are dealt by it."""
    weekly = series.spread_by_keys(stages.active_weekly(sales_lines(spark, folder)), series.PAIR, 16)
    tasks = weekly.withColumn("task", F.spark_partition_id())
    return tasks.groupBy(*series.PAIR).agg(
        F.count("*").alias("weeks"), F.count_distinct("task").alias("tasks")
    )


# top slices


def top_categories(spark, folder):
    return ranking.top_categories(_weekly(spark, folder))


def top_stores_in_top_categories(spark, folder):
    return ranking.top_stores(_weekly(spark, folder))


def top_slice(spark, folder):
    return ranking.top_slice(_weekly(spark, folder))


def top_series_by_peak(spark, folder):
    return ranking.top_series_by_peak(_weekly(spark, folder), 10)


def head_rows(spark, folder):
    days = rollups.store_day_sales(sales_lines(spark, folder))
    return ranking.head_rows(days, ["store_number", "date"])


# forecasts


def _to_tenths(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 1) for c in ("forecast_volume", "fc_sales")})


def forecast_weekly(spark, folder):
    return _to_tenths(arima.forecast_weekly(_weekly(spark, folder, "nation")))


def forecast_top_slice(spark, folder):
    return _to_tenths(stages.forecast_top_slice(_weekly(spark, folder, "nation")))


def forecast_top_series(spark, folder):
    return _to_tenths(stages.forecast_top_series(_weekly(spark, folder, "nation"), 10))


def forecast_store_monthly(spark, folder):
    sales = columns.replace_text_date(sales_lines(spark, folder, "nation"))
    lines = filters.category_window(sales, CATEGORY, "1995-01-01", "2001-12-31")
    return _to_tenths(arima.forecast_store_monthly(lines))


def forecast_stored_models(spark, folder):
    """Models stored, read back and projected without a new fit: no week has come since, so
    these are the forecasts of the fit itself."""
    weekly = _weekly(spark, folder, "nation")
    models = arima.carry(settle(arima.fit_models(weekly)), weekly)
    return _to_tenths(arima.weekly_steps(models))


def _carried(spark, folder, kind):
    """Models fitted without the last eight weeks, stored, carried over them and projected."""
    weekly = settle(_weekly(spark, folder, "nation"))
    before = weekly.filter(F.col("date") <= F.date_sub(filters.max_value(weekly, "date"), 56))
    path = scratch_path(spark)
    write_models(kind.fit_models(before), path)
    return _to_tenths(kind.weekly_steps(kind.carry(spark.read.parquet(path), weekly)))


def forecast_carried(spark, folder):
    return _carried(spark, folder, seasonal_arima)


def forecast_carried_additive(spark, folder):
    return _carried(spark, folder, arima)


def forecast_seasonal(spark, folder):
    return _to_tenths(seasonal_arima.forecast_weekly(_weekly(spark, folder, "nation")))


def seasonal_model_table(spark, folder):
    return seasonal_arima.model_table(seasonal_arima.fit_models(_weekly(spark, folder, "nation")))


def _errors(spark, folder, models):
    found = backtest.holdout_errors(_weekly(spark, folder, "nation"), models)
    return found.withColumns({c: F.round(c, 1) for c in found.columns if c.startswith("mae_")})


def holdout_errors(spark, folder):
    return _errors(spark, folder, {"additive": arima})


def holdout_errors_seasonal(spark, folder):
    return _errors(spark, folder, {"seasonal": seasonal_arima})


def monthly_sales(spark, folder):
    sales = columns.replace_text_date(sales_lines(spark, folder, "nation"))
    lines = filters.category_window(sales, CATEGORY, "1995-01-01", "2001-12-31")
    return arima.monthly_sales(lines)


def model_table(spark, folder):
    return _model_columns(arima.model_table(arima.fit_models(_weekly(spark, folder, "nation"))))


def stored_model_table(spark, folder):
    """Orders and coefficients of models that were stored, from the stored models alone."""
    path = scratch_path(spark)
    write_models(arima.fit_models(_weekly(spark, folder, "nation")), path)
    return _model_columns(arima.model_table(spark.read.parquet(path)))


def _model_columns(models: DataFrame) -> DataFrame:
    """Orders and coefficients, a column each."""
    orders = [F.get("model_order", F.lit(i)).alias(c) for i, c in enumerate(("p", "d", "q", "ps", "sd"))]
    names = [f"{kind}_{i}" for kind in ("ar", "ma") for i in range(1, 6)] + ["seasonal_ar"]
    weights = [
        (F.round(F.get("coefficients", F.lit(i)), 4) + F.lit(0.0)).alias(c) for i, c in enumerate(names, 1)
    ]
    return models.select(
        *SERIES_KEYS,
        "target",
        *orders,
        *weights,
        (F.round(F.get("coefficients", F.lit(0)), 1) + F.lit(0.0)).alias("constant"),
        F.round(F.sqrt("sigma2"), 1).alias("sigma"),
        F.round("aicc", 4).alias("aicc"),
        "n_obs",
        "fallback",
    )


def difference_orders(spark, folder):
    return arima.difference_orders(_weekly(spark, folder, "nation"))


def lag_products(spark, folder):
    """The sums the order search works on: 1, value, its lags and its seasonal lag, each with
    each, over the shared rows."""
    by = [*SERIES_KEYS, "target"]
    long = arima.stack_targets(_weekly(spark, folder, "nation"), SERIES_KEYS, TARGETS)
    sums = arima.product_sums(arima.difference(long, by, 52), by, 52)
    # the table is stored by rows from the diagonal
    places = [(i, j) for i in range(arima.WIDTH) for j in range(i, arima.WIDTH)]
    return sums.select(
        *by,
        F.col("rows_used").cast("int").alias("rows_used"),
        *[
            (F.round(F.get("sums", F.lit(k)), 6) + F.lit(0.0)).alias(f"sum_{i}_{j}")
            for k, (i, j) in enumerate(places)
        ],
    )


def forecast_calendar(spark, folder):
    return series.forecast_calendar(_weekly(spark, folder), SERIES_KEYS)


def forecast_calendar_half_year(spark, folder):
    """Another horizon, from the week after the last one."""
    return series.forecast_calendar(_weekly(spark, folder), SERIES_KEYS, 26, "next")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in ("forecast_volume", "fc_sales")})


def _closed_form(spark: SparkSession, folder: str, model: str) -> DataFrame:
    weekly = _weekly(spark, folder, "nation")
    return _rounded(simple_forecast.forecast_closed_form(weekly, model))


def forecast_auto_sql(spark, folder):
    return _rounded(simple_forecast.forecast_choice(_weekly(spark, folder, "nation")))


# dashboard, on stored drift forecasts


def _forecasts(spark, folder):
    return settle(_closed_form(spark, folder, "drift").drop("srl_num"))


def forecasts_from_csv(spark, folder):
    """Published forecasts, read back from the path of the environment."""
    path = scratch_path(spark)
    write_forecasts(_closed_form(spark, folder, "naive"), path, "csv")
    with patch.dict(os.environ, FORECAST_FILE_LOCATION=path):
        return files.read_forecasts(spark, "csv")


def registered_result(spark, folder):
    """A result registered by name, replacing another, and read back as a table."""
    files.register_result(sales_lines(spark, folder), "registered_result")
    files.register_result(_closed_form(spark, folder, "mean").drop("srl_num"), "registered_result")
    return files.read_forecasts(spark, "table", "registered_result")


def dashboard_choices(spark, folder):
    return dashboard.choices(_forecasts(spark, folder))


def dashboard_volume(spark, folder):
    return dashboard.volume_series(_forecasts(spark, folder), CATEGORY, quarter="2001-Q4")


def dashboard_sales(spark, folder):
    return dashboard.sales_series(_forecasts(spark, folder), CATEGORY)


def dashboard_store(spark, folder):
    return dashboard.selection(_forecasts(spark, folder), "SMALL", store=3, quarter="2001-Q4")


PLAIN = [
    calendar_features,
    parse_dates,
    date_audit,
    value_audit,
    csv_audit,
    sales_from_csv,
    sales_small_stored,
    weekly_from_csv,
    weekly_row_names,
    lowered_names,
    column_listing,
    iso_dates,
    week_start,
    quarter_label,
    last_3_years,
    filter_category_window,
    category_id_lookup,
    last_date_rows,
    active_series,
    active_series_join,
    active_series_bucketed,
    weekly_refresh,
    stored_limits,
    gap_fill,
    daily_sales,
    weekly_sales,
    store_day_sales,
    year_profile,
    category_year_summary,
    yearly_by_category,
    yearly_by_store,
    max_date,
    row_count,
    distinct_stores,
    distinct_categories,
    distinct_counts,
    series_profile,
    series_profile_bitmaps,
    rows_per_category,
    series_number,
    all_series_numbers,
    series_positions,
    nested_series,
    grouped_apply,
    spread_series,
    top_categories,
    top_stores_in_top_categories,
    top_slice,
    top_series_by_peak,
    head_rows,
    forecast_weekly,
    forecast_top_slice,
    forecast_top_series,
    forecast_store_monthly,
    forecast_stored_models,
    forecast_carried,
    forecast_carried_additive,
    forecast_seasonal,
    seasonal_model_table,
    holdout_errors,
    holdout_errors_seasonal,
    monthly_sales,
    model_table,
    stored_model_table,
    difference_orders,
    lag_products,
    forecast_calendar,
    forecast_calendar_half_year,
    forecast_auto_sql,
    forecasts_from_csv,
    registered_result,
    dashboard_choices,
    dashboard_volume,
    dashboard_sales,
    dashboard_store,
]

QUERIES = {f.__name__: f for f in PLAIN} | {
    f"forecast_{m}": partial(_closed_form, model=m) for m in simple_forecast.MODELS
}

#: No SQL: the rounds of the seasonal estimation are compared with brute force in the tests.
NO_SQL = {"forecast_carried", "forecast_seasonal", "seasonal_model_table", "holdout_errors_seasonal"}
