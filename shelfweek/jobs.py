"""The stages as commands, for ``spark-submit`` or ``python -m shelfweek.jobs``.

    ingest     raw sales lines       -> trailing years with calendar columns
    profile    raw sales lines       -> counts, yearly profile and sums, unreadable values
    sums       trailing years        -> weekly sums of all series, in a folder per week
    refresh    trailing years, new   -> the weeks of the new lines summed up again in place
    prepare    trailing years, sums  -> numbered weekly series still active
    forecast   weekly series         -> forecasts of the selected series, and their models
    project    stored models, weekly -> forecasts of stored models carried over new weeks
    monthly    trailing years        -> monthly forecasts of one category, per store
    select     stored forecasts      -> the rows behind a dashboard selection

Paths default to the environment variables DATASET_PATH, DATASET_NAME, DATASET_SMALL_NAME
and FORECAST_FILE_LOCATION. Every stage is told the format it reads and the one it writes;
neither is guessed from a name. Raw sales lines are CSV.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfweek import schemas
from shelfweek.functions import dates
from shelfweek.operators import (
    arima,
    columns,
    dashboard,
    filters,
    observed,
    ranking,
    rollups,
    seasonal_arima,
)
from shelfweek.plans import stages
from shelfweek.session import build_session
from shelfweek.sinks import files as sinks
from shelfweek.sources import files as sources

FORMATS = ["parquet", "csv"]
METHODS = {"additive": arima, "seasonal": seasonal_arima}


def ingest(
    spark: SparkSession,
    source: str,
    target: str,
    years: int = 3,
    target_format: str = "parquet",
    fail_on_bad: bool = False,
    broken: str | None = None,
    report: str | None = None,
) -> dict[str, int]:
    """Counts of lines read, broken, undated and unreadable, and of rows written, taken while
    the job runs. Broken lines, if there are any, are kept aside in ``broken``."""
    schema = schemas.SALES_RAW
    texts = sources.read_texts(spark, source, schema)
    counted, seen = observed.watched(texts, observed.line_counts(schema, sources.BROKEN))
    # the newest date is looked up apart, or its rows would be counted as well
    plain = sources.whole_lines(texts)
    newest = filters.max_value(plain, dates.parse_us_date("date"))
    sales = sources.typed(sources.whole_lines(counted, fail_on_bad), schema, fail_on_bad)
    kept, rows = observed.watched(
        stages.recent_sales(sales, years, newest), {"written": F.count(F.lit(1))}
    )
    sinks.write_sales_small(kept, target, target_format)
    counts = seen.get | rows.get
    if broken and counts["broken"]:
        sinks.write_dataset(sources.broken_lines(spark, source, schema), broken)
    return _reported(spark, "ingest", counts, report)


def _reported(spark: SparkSession, stage: str, counts: dict, path: str | None) -> dict[str, int]:
    if path:
        columns_of = [F.lit(v).alias(k) for k, v in {"stage": stage, **counts}.items()]
        sinks.write_dataset(spark.range(1).select(*columns_of), path)
    return counts


def profile(spark: SparkSession, source: str, target: str, target_format: str = "parquet"):
    """One dataset per table under ``target``."""
    sales = sources.read_sales(spark, source)
    dated = sales.withColumn("year", F.year(dates.parse_us_date("date")))
    tables = {
        "years": rollups.year_profile(sales),
        "category_years": rollups.category_year_summary(dated),
        "counts": rollups.distinct_counts(
            sales, {"store_number": "n_stores", "category_name": "n_categories"}
        ),
        "unreadable": columns.value_audit(
            sources.read_texts(spark, source, schemas.SALES_RAW),
            schemas.SALES_RAW,
            broken=sources.BROKEN,
        ),
    }
    for name, table in tables.items():
        sinks.write_dataset(table, f"{target.rstrip('/')}/{name}", target_format)


def _small(spark: SparkSession, source: str, source_format: str) -> DataFrame:
    """The stored window with ``date`` as a date; it is parsed only where it was not yet."""
    sales = sources.read_sales_small(spark, source, source_format)
    if "date_parsed" in sales.columns:
        return sales.withColumn("date", F.col("date_parsed")).drop("date_parsed")
    return columns.replace_text_date(sales)


def sums(spark: SparkSession, source: str, target: str, source_format: str = "parquet"):
    stages.build_weekly_sums(_small(spark, source, source_format), target, parsed=True)


def refresh(
    spark: SparkSession, source: str, new: str, target: str, source_format: str = "parquet"
) -> dict[str, int]:
    """``source`` holds all lines, those of ``new`` among them."""
    lines = _small(spark, source, source_format)
    found = _small(spark, new, source_format)
    weeks = stages.refresh_weekly_sums(lines, found, target, parsed=True)
    return {"weeks": len(weeks)}


def prepare(
    spark: SparkSession,
    source: str,
    target: str,
    fill_gaps: bool = False,
    source_format: str = "parquet",
    target_format: str = "parquet",
    report: str | None = None,
    from_sums: bool = False,
) -> dict[str, int] | None:
    """Counts of rows read and of those without a date, which are dropped. ``from_sums`` takes
    stored weekly sums as the source."""
    if from_sums:
        weekly = stages.numbered_sums(sources.read_weekly_sums(spark, source), fill_gaps)
        sinks.write_dataset(weekly.select(*schemas.WEEKLY.fieldNames()), target, target_format)
        return None
    sales, seen = observed.watched(_small(spark, source, source_format), observed.dated_counts())
    weekly = stages.weekly_relation(sales, fill_gaps, parsed=True)
    sinks.write_dataset(weekly.select(*schemas.WEEKLY.fieldNames()), target, target_format)
    return _reported(spark, "prepare", seen.get, report)


def select_series(
    weekly: DataFrame, categories: int | None, stores: int | None, series: int | None
) -> DataFrame:
    """The top stores within the top categories, or the top series, or all."""
    if (categories is None) != (stores is None):
        raise ValueError("categories and stores go together")
    if series is not None and categories is not None:
        raise ValueError("choose series, or categories and stores, not both")
    if series is not None:
        return ranking.top_series_by_peak(weekly, series)
    if categories is not None:
        return ranking.top_slice(weekly, categories, stores)
    return weekly


def forecast(
    spark: SparkSession,
    source: str,
    target: str,
    models: str | None = None,
    categories: int | None = None,
    stores: int | None = None,
    series: int | None = None,
    horizon: int = 18,
    first_step: str = "last",
    source_format: str = "parquet",
    target_format: str = "csv",
    method: str = "additive",
    state: str | None = None,
):
    """``method`` names the kind of ARIMA: ``additive`` has one seasonal lag added, ``seasonal``
    multiplies seasonal lags and residuals in. ``state`` stores the models for ``project``."""
    dates.check_horizon(horizon)
    model = METHODS[method]
    weekly = sources.read_weekly(spark, source, source_format)
    chosen = sources.register_result(select_series(weekly, categories, stores, series))
    # fitted once: the forecasts and the model table are those of the same models
    fitted = sinks.settle(model.fit_models(chosen))
    steps = model.weekly_steps(fitted, horizon, first_step=first_step)
    sinks.write_forecasts(steps, target, target_format)
    if models:
        sinks.write_models(model.model_table(fitted), models)
    if state:
        sinks.write_models(fitted, state)
    sinks.forget(fitted)


def project(
    spark: SparkSession,
    state: str,
    source: str,
    target: str,
    method: str = "additive",
    carried: str | None = None,
    horizon: int = 18,
    first_step: str = "last",
    source_format: str = "parquet",
    target_format: str = "csv",
):
    """Forecasts of the models ``forecast`` stored in ``state``, carried over the weeks of
    ``source`` that came since; ``carried`` stores them as they are then."""
    dates.check_horizon(horizon)
    model = METHODS[method]
    weekly = sources.read_weekly(spark, source, source_format)
    moved = sinks.settle(model.carry(spark.read.parquet(state), weekly))
    sinks.write_forecasts(model.weekly_steps(moved, horizon, first_step=first_step), target, target_format)
    if carried:
        sinks.write_models(moved, carried)
    sinks.forget(moved)


def monthly(
    spark: SparkSession,
    source: str,
    target: str,
    category: str,
    start: str,
    end: str,
    horizon: int = 12,
    source_format: str = "parquet",
    target_format: str = "csv",
):
    dates.check_horizon(horizon)
    sales = _small(spark, source, source_format)
    lines = filters.category_window(sales, category, start, end)
    sinks.write_dataset(arima.forecast_store_monthly(lines, horizon), target, target_format)


def select(
    spark: SparkSession,
    source: str,
    target: str,
    category: str,
    store: str = dashboard.ALL_STORES,
    quarter: str = dashboard.FULL_FORECAST,
    source_format: str = "csv",
    target_format: str = "csv",
):
    forecasts = sources.read_forecasts(spark, source_format, source)
    rows = dashboard.selection(forecasts, category, store, quarter)
    sinks.write_dataset(rows, target, target_format)


def _formats(parser, source: str | None, target: str) -> None:
    if source:
        parser.add_argument("--source-format", default=source, choices=FORMATS)
    parser.add_argument("--target-format", default=target, choices=FORMATS)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shelfweek")
    stage = parser.add_subparsers(dest="stage", required=True)

    p = stage.add_parser("ingest")
    p.add_argument("--source", default=sources.dataset_path())
    p.add_argument("--target", default=sources.dataset_path(small=True))
    p.add_argument("--years", type=int, default=3)
    p.add_argument("--fail-on-bad", action="store_true")
    p.add_argument("--broken")
    p.add_argument("--report")
    _formats(p, None, "parquet")

    p = stage.add_parser("profile")
    p.add_argument("--source", default=sources.dataset_path())
    p.add_argument("--target", required=True)
    _formats(p, None, "parquet")

    p = stage.add_parser("sums")
    p.add_argument("--source", default=sources.dataset_path(small=True))
    p.add_argument("--target", required=True)
    p.add_argument("--source-format", default="parquet", choices=FORMATS)

    p = stage.add_parser("refresh")
    p.add_argument("--source", default=sources.dataset_path(small=True))
    p.add_argument("--new", required=True)
    p.add_argument("--target", required=True)
    p.add_argument("--source-format", default="parquet", choices=FORMATS)

    p = stage.add_parser("prepare")
    p.add_argument("--from-sums", action="store_true")
    p.add_argument("--source", default=sources.dataset_path(small=True))
    p.add_argument("--target", required=True)
    p.add_argument("--fill-gaps", action="store_true")
    p.add_argument("--report")
    _formats(p, "parquet", "parquet")

    p = stage.add_parser("forecast")
    p.add_argument("--source", required=True)
    p.add_argument("--target", default=sources.forecast_path())
    p.add_argument("--models")
    p.add_argument("--categories", type=int)
    p.add_argument("--stores", type=int)
    p.add_argument("--series", type=int)
    p.add_argument("--horizon", type=int, default=18)
    p.add_argument("--first-step", default="last", choices=["last", "next"])
    _formats(p, "parquet", "csv")

    p.add_argument("--method", default="additive", choices=list(METHODS))
    p.add_argument("--state")

    p = stage.add_parser("project")
    p.add_argument("--state", required=True)
    p.add_argument("--source", required=True)
    p.add_argument("--target", default=sources.forecast_path())
    p.add_argument("--method", default="additive", choices=list(METHODS))
    p.add_argument("--carried")
    p.add_argument("--horizon", type=int, default=18)
    p.add_argument("--first-step", default="last", choices=["last", "next"])
    _formats(p, "parquet", "csv")

    p = stage.add_parser("monthly")
    p.add_argument("--source", default=sources.dataset_path(small=True))
    p.add_argument("--target", required=True)
    p.add_argument("--category", required=True)
    p.add_argument("--start", required=True)
    p.add_argument("--end", required=True)
    p.add_argument("--horizon", type=int, default=12)
    _formats(p, "parquet", "csv")

    p = stage.add_parser("select")
    p.add_argument("--source", default=sources.forecast_path())
    p.add_argument("--target", required=True)
    p.add_argument("--category", required=True)
    p.add_argument("--store", default=dashboard.ALL_STORES)
    p.add_argument("--quarter", default=dashboard.FULL_FORECAST)
    _formats(p, "csv", "csv")

    options = vars(parser.parse_args(argv))
    stages_of = (ingest, profile, sums, refresh, prepare, forecast, project, monthly, select)
    commands = {f.__name__: f for f in stages_of}
    counts = commands[options.pop("stage")](build_session(), **options)
    if counts is not None:
        print(json.dumps(counts))


if __name__ == "__main__":
    main()
