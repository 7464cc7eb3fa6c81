"""How far forecasts were off: the last weeks of every series held out, forecast from the
rest, and compared with what was sold."""

from __future__ import annotations

from types import ModuleType

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfweek.operators import arima
from shelfweek.schemas import SERIES_KEYS, TARGETS

#: Rows a series keeps at least when its last ones are held out.
FEWEST_LEFT = 4


def split(weekly: DataFrame, weeks: int = 8, keys: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows to fit on, and the last ``weeks`` rows of each series, numbered by ``step``.
    Series too short to lose that many are left out. A step is an observed week, as a lag is."""
    own = Window.partitionBy(*(keys or SERIES_KEYS))
    back = F.row_number().over(own.orderBy(F.desc("date")))
    placed = weekly.filter(F.col("date").isNotNull()).withColumns(
        {"_back": back, "_n": F.count(F.lit(1)).over(own)}
    )
    placed = placed.filter(F.col("_n") >= weeks + FEWEST_LEFT).drop("_n")
    held = placed.filter(F.col("_back") <= weeks)
    held = held.withColumn("step", F.lit(weeks + 1) - F.col("_back")).drop("_back")
    return placed.filter(F.col("_back") > weeks).drop("_back"), held


def naive_paths(
    series: DataFrame, horizon: int, season: int, keys: list[str], targets: dict[str, str]
) -> DataFrame:
    """Per series and target the last value, and the values a season ago, as arrays."""
    long = arima.stack_targets(series, keys, targets)
    place = F.row_number().over(Window.partitionBy(*keys, "target").orderBy(F.desc("date")))
    recent = long.withColumn("_back", place).filter(F.col("_back") <= season)
    tail = recent.groupBy(*keys, "target").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_back", "y"))), lambda r: r["y"]).alias("y")
    )
    steps = F.sequence(F.lit(0), F.lit(horizon - 1))
    ago = F.transform(steps, lambda k: F.get("y", F.lit(season - 1) - k % season))
    last = F.array_repeat(F.get("y", F.lit(0)), horizon)
    return tail.select(
        *keys,
        "target",
        last.alias("naive"),
        F.when(F.size("y") >= season, ago).otherwise(last).alias("seasonal_naive"),
    )


def holdout_errors(
    weekly: DataFrame,
    models: dict[str, ModuleType],
    weeks: int = 8,
    season: int = 52,
    keys: list[str] | None = None,
) -> DataFrame:
    """Per series and target the mean absolute error over the held-out weeks, of each of the
    ``models`` (name to a module with ``fit_models`` and ``project``), of the last value and
    of the value a season ago, in columns ``mae_<name>``."""
    keys = keys or SERIES_KEYS
    by = [*keys, "target"]
    left, held = split(weekly, weeks, keys)
    paths = naive_paths(left, weeks, season, keys, TARGETS)
    for name, module in models.items():
        fitted = module.project(module.fit_models(left, keys, season=season), weeks, season)
        fitted = fitted.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("path").alias(name))
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
        paths = paths.join(fitted, same).drop(*[f"_{c}" for c in by])
    names = [*models, "naive", "seasonal_naive"]
    actual = arima.stack_targets(held.withColumn("_step", F.col("step")), [*keys, "_step"], TARGETS)
    actual = actual.select(*[F.col(c).alias(f"_{c}") for c in by], "_step", "y")
    met = paths.join(actual, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    off = [
        F.avg(F.abs(F.col("y") - F.get(name, F.col("_step") - 1))).alias(f"mae_{name}")
        for name in names
    ]
    return met.groupBy(*by).agg(F.count(F.lit(1)).cast("int").alias("n_weeks"), *off)
