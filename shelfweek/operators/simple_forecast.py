"""Closed-form forecasts as plain column expressions, and a choice among them.

Each is a special case of the ARIMA family: the mean, the last value (naive), the last
value plus the average step (drift), the value one season earlier (seasonal naive) and
a first-order autoregression. One window gives every row its neighbours, one aggregation
reduces a series to a few exact sums, and the steps ahead are expressions over those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfweek.functions.dates import check_horizon
from shelfweek.functions.measures import readable
from shelfweek.operators.series import step_shift
from shelfweek.schemas import SERIES_KEYS

MODELS = ["mean", "naive", "drift", "snaive", "ar1"]
# free parameters of each model, the error variance included
PARAMETERS = {"mean": 2, "naive": 1, "drift": 2, "snaive": 1, "ar1": 3}
OUTPUT = {"total_volume_sold": "forecast_volume", "total_sales": "fc_sales"}
# Seasonal naive takes part in the choice only with this many seasonal differences: the
# forms are compared on the rows all of them have, and fewer rows say little. Documented
# default, ``seasonal_pairs`` sets another.
SEASONAL_PAIRS = 10


# weekly totals are taken as whole 1/10000ths here, so that sums of products stay exact
UNITS = 10000.0
LARGEST = 9e13


def wide_units(c: str) -> Column:
    x = readable(c)
    fits = F.when(F.abs(x) < LARGEST, F.rint(x * F.lit(UNITS)).cast("decimal(18,0)"))
    return fits.when(x.isNotNull(), F.raise_error(F.lit("a weekly total is too large for exact products")))


def _dbl(c: Column) -> Column:
    return c.cast("double")


class Fields:
    """The columns that belong to one measure: ``f["mean"]`` is ``total_sales_mean``.

    Plain columns rather than a struct, so that Spark leaves out the sums and neighbours
    a model does not use.
    """

    def __init__(self, measure: str):
        self.measure = measure

    def __getitem__(self, name: str) -> Column:
        return F.col(f"{self.measure}_{name}")

    def named(self, columns: dict[str, Column]) -> list[Column]:
        return [c.alias(f"{self.measure}_{name}") for name, c in columns.items()]


def series_facts(
    weekly: DataFrame, keys: list[str], season: int, seasonal_pairs: int = SEASONAL_PAIRS
) -> DataFrame:
    """One row per series: its end, and exact sums per measure."""
    back = Window.partitionBy(*keys).orderBy(F.desc("date"))
    rows = weekly.filter(F.col("date").isNotNull()).withColumns(
        {
            "_back": F.row_number().over(back),
            "_n": F.count(F.lit(1)).over(Window.partitionBy(*keys)),
        }
    )
    for m in OUTPUT:
        rows = rows.withColumn(f"_{m}", F.coalesce(wide_units(m), F.lit(0).cast("decimal(18,0)")))
    for m in OUTPUT:
        y = F.col(f"_{m}")
        rows = rows.withColumns(
            {f"_{m}_prev": F.lead(y, 1).over(back), f"_{m}_season": F.lead(y, season).over(back)}
        )
    # the choice between models looks at the same rows for all of them
    seasonal = F.col("_n") >= season + seasonal_pairs
    longest = F.when(seasonal, season).otherwise(1)
    rows = rows.withColumn("_common", F.col("_back") <= F.col("_n") - longest)
    return rows.groupBy(*keys).agg(
        F.max("date").alias("last_date"),
        F.max("_n").alias("n"),
        F.max(seasonal).alias("seasonal"),
        F.count_if("_common").alias("common_n"),
        *[c for m in OUTPUT for c in Fields(m).named(_measure_facts(m, season))],
    )


def _measure_facts(m: str, season: int) -> dict[str, Column]:
    y, prev, year_ago = F.col(f"_{m}"), F.col(f"_{m}_prev"), F.col(f"_{m}_season")
    paired, common = prev.isNotNull(), F.col("_common")
    season_rows = F.when(F.col("_back") <= season, F.struct("date", y.alias("y")))
    sums = {
        "total": F.sum(y),
        "first": F.min_by(y, "date"),
        "last": F.max_by(y, "date"),
        # seasonal naive: the last season, oldest first
        "tail": F.transform(
            F.sort_array(F.collect_list(season_rows)), lambda r: r["y"].cast("double")
        ),
    }
    for name, on in (("pair", paired), ("common", common)):
        sums |= {
            f"{name}_y": F.sum(F.when(on, y)),
            f"{name}_x": F.sum(F.when(on, prev)),
            f"{name}_yy": F.sum(F.when(on, y * y)),
            f"{name}_xx": F.sum(F.when(on, prev * prev)),
            f"{name}_xy": F.sum(F.when(on, y * prev)),
        }
    gap = y - year_ago
    sums["season_dd"] = F.sum(F.when(common, (gap * gap).cast("decimal(38,0)")))
    return sums


def _centred(f: Fields, part: str, a: str, b: str, n: Column) -> Column:
    """n times the centred sum of products, subtracted exactly before leaving decimals."""
    count = n.cast("decimal(10,0)")
    ab = "".join(sorted(a + b))
    return _dbl(
        count * f[f"{part}_{ab}"]
        - f[f"{part}_{a}"].cast("decimal(28,0)") * f[f"{part}_{b}"].cast("decimal(28,0)")
    )


def _endings(facts: DataFrame, keys: list[str], extra: list[str]) -> DataFrame:
    """Per measure the few numbers the steps ahead are made of, worked out once a series."""
    n = F.col("n")

    def ending(f: Fields) -> dict[str, Column]:
        pairs = n - 1
        var = _centred(f, "pair", "x", "x", pairs)
        slope = F.when(var > 0, _centred(f, "pair", "x", "y", pairs) / var)
        step = (_dbl(f["last"]) - _dbl(f["first"])) / F.nullif(pairs, F.lit(0))
        return {
            "mean": _dbl(f["total"]) / n,
            "last": _dbl(f["last"]),
            "step": F.coalesce(step, F.lit(0.0)),
            "slope": slope,
            "constant": (_dbl(f["pair_y"]) - slope * _dbl(f["pair_x"])) / pairs,
            "tail": f["tail"],
        }

    return facts.select(
        *keys,
        "last_date",
        "n",
        *extra,
        *[c for m in OUTPUT for c in Fields(m).named(ending(Fields(m)))],
    )


def point(model: str, f: Fields, n: Column, k: Column, season: int) -> Column:
    """Value ``k`` steps after the end of a series, from its ending."""
    if model == "mean":
        units = f["mean"]
    elif model == "naive":
        units = f["last"]
    elif model == "drift":
        units = f["last"] + f["step"] * k
    elif model == "snaive":
        # a series shorter than one season has nothing a season ago
        place = F.pmod(k - 1, F.lit(season))
        units = F.when(n >= season, F.get(f["tail"], place)).otherwise(f["last"])
    elif model == "ar1":
        level = f["constant"] / (F.lit(1.0) - f["slope"])
        stationary = (n >= 3) & (F.abs(f["slope"]) < 1.0)
        back = level + F.pow(f["slope"], k) * (f["last"] - level)
        units = F.when(stationary, back).otherwise(f["mean"])
    else:
        raise ValueError(f"unknown model {model!r}, known: {MODELS}")
    return units / F.lit(UNITS)


def squared_errors(model: str, f: Fields, n: Column) -> Column:
    """Sum of squared one-step errors over the common rows, in units squared."""
    syy = _centred(f, "common", "y", "y", n) / n
    sxx = _centred(f, "common", "x", "x", n) / n
    sxy = _centred(f, "common", "x", "y", n) / n
    steps = f["common_yy"] + f["common_xx"] - 2 * f["common_xy"]
    shift = _dbl(f["common_y"] - f["common_x"])
    if model == "mean":
        return syy
    if model == "naive":
        return _dbl(steps)
    if model == "drift":
        return _dbl(steps) - shift * shift / n
    if model == "snaive":
        return _dbl(f["season_dd"])
    if model == "ar1":
        return F.when(sxx > 0, syy - sxy * sxy / sxx)
    raise ValueError(f"unknown model {model!r}, known: {MODELS}")


def aicc(model: str, f: Fields, n: Column, seasonal: Column) -> Column:
    """Corrected Akaike criterion; NULL where the model cannot take part."""
    k = PARAMETERS[model]
    sse = F.greatest(squared_errors(model, f, n), F.lit(1.0))
    value = n * F.log(sse / n) + 2.0 * k + F.lit(2.0 * k * (k + 1)) / F.nullif(n - k - 1, F.lit(0))
    able = n > k + 1
    if model == "snaive":
        able = able & seasonal
    if model == "ar1":
        able = able & (F.abs(_slope_on_common(f, n)) < 1.0)
    return F.when(able, value)


def _slope_on_common(f: Fields, n: Column) -> Column:
    var = _centred(f, "common", "x", "x", n)
    return F.when(var > 0, _centred(f, "common", "x", "y", n) / var)


def best_model(f: Fields, n: Column, seasonal: Column) -> Column:
    """Name of the model with the smallest criterion, the earlier one on a tie; the mean
    for a series too short for any of them."""
    scored = F.array(
        *[
            F.struct(
                F.coalesce(aicc(m, f, n, seasonal), F.lit(float("inf"))).alias("aicc"),
                F.lit(i).alias("rank"),
            )
            for i, m in enumerate(MODELS)
        ]
    )
    return F.element_at(F.array(*[F.lit(m) for m in MODELS]), F.array_min(scored)["rank"] + 1)


def _steps(facts: DataFrame, horizon: int, first_step: str) -> DataFrame:
    shift = step_shift(first_step) - 7
    check_horizon(horizon)
    steps = facts.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return steps.withColumn("Date", F.date_add("last_date", F.col("_k") * 7 + shift))


def forecast_closed_form(
    weekly: DataFrame,
    model: str,
    horizon: int = 18,
    season: int = 52,
    first_step: str = "last",
    keys: list[str] | None = None,
) -> DataFrame:
    """Forecast both measures of every series by one of ``MODELS``."""
    keys = keys or SERIES_KEYS
    ends = _endings(series_facts(weekly, keys, season), keys, [])
    steps = _steps(ends, horizon, first_step)
    values = {
        out: point(model, Fields(m), F.col("n"), F.col("_k"), season) for m, out in OUTPUT.items()
    }
    return steps.select(*keys, "Date", *[c.alias(name) for name, c in values.items()])


def forecast_choice(
    weekly: DataFrame,
    horizon: int = 18,
    season: int = 52,
    first_step: str = "last",
    keys: list[str] | None = None,
    seasonal_pairs: int = SEASONAL_PAIRS,
) -> DataFrame:
    """Forecast each measure of each series by the closed form with the smallest AICc.

    The choice is made on common rows; the chosen form then uses the whole series.
    """
    keys = keys or SERIES_KEYS
    facts = series_facts(weekly, keys, season, seasonal_pairs)
    names = {"total_volume_sold": "volume_model", "total_sales": "sales_model"}
    chosen = facts.withColumns(
        {
            name: best_model(Fields(m), F.col("common_n"), F.col("seasonal"))
            for m, name in names.items()
        }
    )
    steps = _steps(_endings(chosen, keys, list(names.values())), horizon, first_step)

    def value(m):
        picked = None
        for model in MODELS:
            expr = point(model, Fields(m), F.col("n"), F.col("_k"), season)
            test = F.col(names[m]) == model
            picked = F.when(test, expr) if picked is None else picked.when(test, expr)
        return picked

    return steps.select(
        *keys, "Date", *names.values(), *[value(m).alias(out) for m, out in OUTPUT.items()]
    )
