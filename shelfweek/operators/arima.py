"""ARIMA with automatic order, estimated by grouped sums.

All work that grows with the data is windows and one grouped sum in Spark:

1. both measures of a series are stacked and standardised, seasonal strength decides on a
   seasonal difference and the KPSS statistic on up to two ordinary ones;
2. the differenced value gets its lags as columns, and one aggregation adds up all their
   products. This table of sums holds everything least squares needs.

Estimation follows Hannan and Rissanen: a long autoregression gives residuals, and the
value is regressed on lags of itself and of the residuals. As a residual is a weighted sum
of lags, sums of products with residuals follow from the same table by a matrix product,
so the rows are read once and every order is fitted from a sub-table. Only that step, on
one small array per series, leaves the JVM; it solves all series of an Arrow batch at once.
The forecast itself is an array fold over the last values.

Orders: p, q up to 5, one additive seasonal lag, at most 5 terms, chosen by AICc
over the same rows for every order. Exact likelihood values are not reproduced. A series of
fewer than 27 values looks back less far: of n values (n - 3) / 2 are used as lags at most,
five in twelve of them by the order searched and the rest by the long autoregression.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfweek.functions.dates import check_horizon
from shelfweek.functions.measures import total_or_zero
from shelfweek.operators.series import spread_by_keys, step_shift
from shelfweek.schemas import SERIES_KEYS, TARGETS

# fixed values: limits of the search and critical values of the tests
MAX_TERMS = 5
LONG_ORDER = 7
SEASONAL_STRENGTH = 0.64
KPSS_CRITICAL = 0.463
ROOT_LIMIT = 1.01
FEWEST = 4

LAGS = MAX_TERMS + LONG_ORDER
# columns of the product table: 1, value, its lags, its seasonal lag
WIDTH = LAGS + 3
NEGLIGIBLE = 1e-10


def stack_targets(series: DataFrame, keys: list[str], targets: dict[str, str]) -> DataFrame:
    """One row per series, target and date, without missing dates. Rows stay where they are:
    a table bucketed by the keys keeps that for what follows."""
    values = [
        F.struct(F.lit(name).alias("target"), F.when(~F.isnan(c), F.col(c)).alias("y"))
        for name, c in targets.items()
    ]
    long = series.select(*keys, "date", F.inline(F.array(*values)))
    return long.filter(F.col("date").isNotNull() & F.col("y").isNotNull())


def _kpss(deviations: Column, count: Column) -> Column:
    """Level-stationarity statistic of an array of deviations from their mean (0 where there
    is none), 0 for a constant series.

    The long-run variance with Bartlett weights of bandwidth b is the sum of squared moving
    sums of b + 1 deviations, the series continued by zeros, over b + 1: moving sums are
    differences of running sums, so no lag is taken and b may be any number.
    """
    # a name for each array, so that it is worked out once
    return F.get(
        F.transform(
            F.array(
                F.struct(
                    deviations.alias("e"),
                    F.aggregate(
                        deviations,
                        F.array(F.lit(0.0)),
                        lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)),
                    ).alias("s"),
                    F.floor(3 * F.sqrt(count) / 13).cast("int").alias("b"),
                )
            ),
            lambda r: _kpss_of(r["e"], r["s"], r["b"], count),
        ),
        F.lit(0),
    )


def _kpss_of(e: Column, s: Column, b: Column, count: Column) -> Column:
    def squares(v):
        return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x)

    # s begins with the 0 before the first value
    after = F.concat(F.slice(s, F.lit(2), F.size(e)), F.array_repeat(F.element_at(s, -1), b))
    before = F.slice(F.concat(F.array_repeat(F.lit(0.0), b), s), F.lit(1), F.size(e) + b)
    moving = F.zip_with(after, before, lambda x, y: x - y)
    spread = squares(moving) / (b + 1)
    stat = F.try_divide(squares(s), count * spread)
    return F.coalesce(F.when(squares(e) > NEGLIGIBLE * count, stat), F.lit(0.0))


def difference(long: DataFrame, by: list[str], season: int) -> DataFrame:
    """Add standardised (``x``), seasonally (``z``) and fully (``w``) differenced values,
    with the numbers of differences ``sd`` and ``d``.

    Every window copies the rows once more, so what can share one does: all lags of ``y`` are
    taken at once, and both kinds of mean before it is known which of them will be used.
    """
    whole = Window.partitionBy(*by)
    ordered = whole.orderBy("date")
    back = [1, 2, season, season + 1, season + 2]
    rows = long.withColumns(
        {"t": F.row_number().over(ordered)}
        | {f"_y{j}": F.lag("y", j).over(ordered) for j in dict.fromkeys(back)}
    )
    step, over, over_step = "y - _y1", f"y - _y{season}", f"y - _y{season} - _y1 + _y{season + 1}"
    rows = rows.withColumns(
        {
            "n": F.count(F.lit(1)).over(whole),
            "centre": F.avg("y").over(whole),
            "scale": F.stddev_pop("y").over(whole),
            "_slope": F.regr_slope("y", "t").over(whole),
            "_start": F.regr_intercept("y", "t").over(whole),
            "_step": F.avg(F.expr(step)).over(whole),
            "_over": F.avg(F.expr(over)).over(whole),
            "_over_step": F.avg(F.expr(over_step)).over(whole),
        }
    )
    varies = F.col("scale") > NEGLIGIBLE * F.greatest(F.abs("centre"), F.lit(1.0))

    def scaled(value: str) -> Column:
        # differences of a constant series are 0, those before its start missing
        v = F.expr(value)
        return F.when(varies, v / F.col("scale")).when(v.isNotNull(), F.lit(0.0))

    # seasonal strength: how much of the variance around a straight line is left
    # after taking out the mean of each place in the season
    rows = rows.withColumn("_off", F.coalesce(scaled("y - _start - _slope * t"), F.lit(0.0)))
    place = Window.partitionBy(*by, F.col("t") % season)
    rows = rows.withColumn("_rest", F.col("_off") - F.avg("_off").over(place))
    rows = rows.withColumns(
        {"_about": F.var_pop("_off").over(whole), "_left": F.var_pop("_rest").over(whole)}
    )
    about = F.col("_about")
    strength = F.when(about > NEGLIGIBLE, 1 - F.col("_left") / F.nullif(about, F.lit(0.0)))
    seasonal = (F.col("n") >= 2 * season + 8) & (
        F.coalesce(strength, F.lit(0.0)) > SEASONAL_STRENGTH
    )
    rows = rows.withColumn("sd", seasonal.cast("int"))

    def either(over_season: str, plain: str) -> Column:
        return F.when(F.col("sd") == 1, scaled(over_season)).otherwise(scaled(plain))

    older = f"_y1 - _y{season + 1} - _y2 + _y{season + 2}"
    rows = rows.select(
        *by,
        "date",
        "t",
        "n",
        "sd",
        "centre",
        "scale",
        scaled("y - centre").alias("x"),
        either(over, "y - centre").alias("z"),
        either(over_step, step).alias("_z1"),
        either(f"{over_step} - ({older})", "y - 2 * _y1 + _y2").alias("_z2"),
        either(f"{over} - _over", "y - centre").alias("_e0"),
        either(f"{over_step} - _over_step", f"{step} - _step").alias("_e1"),
    )
    # a series is at most one row per week: the statistic is taken from arrays of them
    kept = ["t", "date", "centre", "scale", "x", "z", "_z1", "_z2", "_e0", "_e1"]
    nested = rows.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct(*kept))).alias("_rows"),
        F.max("n").alias("n"),
        F.max("sd").alias("sd"),
    )
    left_over = F.col("n") - F.col("sd") * season

    def deviations(i):
        return F.transform(f"_rows._e{i}", lambda v: F.coalesce(v, F.lit(0.0)))

    nested = nested.withColumns(
        {
            "_stat0": _kpss(deviations(0), left_over.cast("double")),
            "_stat1": _kpss(deviations(1), F.greatest(left_over - 1, F.lit(1)).cast("double")),
        }
    )
    d = F.when(F.col("_stat0") <= KPSS_CRITICAL, 0).when(F.col("_stat1") <= KPSS_CRITICAL, 1)
    nested = nested.select(*by, "n", "sd", d.otherwise(2).alias("d"), "_rows")
    level = nested.select(*by, "n", "sd", "d", F.inline("_rows"))
    w = F.when(F.col("d") == 0, F.col("z")).when(F.col("d") == 1, F.col("_z1"))
    return level.select(
        *by,
        "date",
        "t",
        "n",
        "sd",
        "d",
        "centre",
        "scale",
        "x",
        "z",
        w.otherwise(F.col("_z2")).alias("w"),
    )


def difference_orders(
    series: DataFrame,
    keys: list[str] | None = None,
    targets: dict[str, str] | None = None,
    season: int = 52,
) -> DataFrame:
    """Numbers of ordinary (``d``) and seasonal (``sd``) differences per series and target."""
    by = [*(keys or SERIES_KEYS), "target"]
    rows = difference(stack_targets(series, by[:-1], targets or TARGETS), by, season)
    return rows.groupBy(*by).agg(*[F.max(c).cast("int").alias(c) for c in ("n", "d", "sd")])


def product_sums(rows: DataFrame, by: list[str], season: int) -> DataFrame:
    """One row per series and target: the sums of products of lags over the rows all orders
    share, and the last values, newest first."""
    ordered = Window.partitionBy(*by).orderBy("date")
    length = F.col("n") - F.col("sd") * season - F.col("d")
    rows = rows.withColumns(
        {f"_l{j}": F.lag("w", j).over(ordered) for j in range(1, LAGS + 1)}
        | {"_ls": F.lag("w", season).over(ordered)}
    )
    # a seasonal lag costs a season of rows, so it needs two seasons and some
    has_season = length >= 2 * season + LAGS
    reach = F.least(F.lit(LAGS), F.greatest(F.lit(0), F.floor((length - 3) / 2))).cast("int")
    first = F.when(has_season, F.greatest(F.lit(LAGS), F.lit(season))).otherwise(reach)
    place = F.col("t") - F.col("sd") * season - F.col("d")
    shared = place > first
    values = [F.lit(1.0), F.col("w"), *[F.col(f"_l{j}") for j in range(1, LAGS + 1)]]
    values.append(F.when(has_season, F.col("_ls")).otherwise(0.0))
    rows = rows.withColumns(
        {f"_v{i}": F.coalesce(F.when(shared, v), F.lit(0.0)) for i, v in enumerate(values)}
    )
    products = [
        F.expr(f"sum(_v{i} * _v{j})")
        for i in range(WIDTH)
        for j in range(i, WIDTH)
    ]
    recent = F.col("t") > F.col("n") - (max(season, LAGS) + 1)
    tail = F.collect_list(F.when(recent, F.struct("t", "w", "z", "x")))
    return rows.groupBy(*by).agg(
        F.array(*products).alias("sums"),
        F.count_if(shared).alias("rows_used"),
        F.max(has_season).alias("has_season"),
        F.max(reach).alias("reach"),
        F.sort_array(tail, asc=False).alias("tail"),
        F.max("date").alias("last_date"),
        *[F.max(c).alias(c) for c in ("n", "d", "sd", "centre", "scale")],
    )


def _solve(table: np.ndarray, terms: list[int], target: int) -> tuple[np.ndarray, np.ndarray]:
    """Least squares of one column on others, for a stack of product tables.

    A column without weight next to the target, such as the residuals of an exact fit, is
    rounding noise and gets the coefficient 0.
    """
    a = table[:, terms][:, :, terms]
    power = np.diagonal(a, axis1=1, axis2=2)
    live = power > np.maximum(NEGLIGIBLE * table[:, target, target], 1e-30)[:, None]
    b = np.where(live, table[:, terms, target], 0.0)
    size = np.sqrt(np.where(live, power, 1.0))
    both = live[:, :, None] & live[:, None, :]
    unit = np.where(both, a / (size[:, :, None] * size[:, None, :]), 0.0)
    unit += np.eye(len(terms)) * np.where(live, 1e-10, 1.0)[:, :, None]
    right = (b / size)[:, :, None]
    try:
        beta = np.linalg.solve(unit, right)[:, :, 0] / size
    except np.linalg.LinAlgError:
        # one series of the batch must not fail the others
        beta = (np.linalg.pinv(unit) @ right)[:, :, 0] / size
    fit = np.einsum("bi,bij,bj->b", beta, a, beta)
    return beta, table[:, target, target] - 2 * (b * beta).sum(1) + fit


def _stable(weights: np.ndarray) -> np.ndarray:
    """Whether 1 - sum(w_i z^i) has all roots beyond ``ROOT_LIMIT``: with that radius scaled
    to 1, the recursion is stepped down one order at a time."""
    a = weights * ROOT_LIMIT ** np.arange(1, weights.shape[1] + 1)
    ok = np.ones(len(a), bool)
    for k in range(a.shape[1], 0, -1):
        r = a[:, k - 1].copy()
        ok &= np.abs(r) < 1
        r[~ok] = 0.0
        a = (a[:, : k - 1] + r[:, None] * a[:, : k - 1][:, ::-1]) / (1 - r * r)[:, None]
    return ok


def choose_orders(
    table: np.ndarray,
    count: np.ndarray,
    has_season: np.ndarray,
    may_shift: np.ndarray,
    season: int,
    reach: np.ndarray | int = LAGS,
) -> dict[str, np.ndarray]:
    """Best order and weights for a stack of product tables (series, WIDTH, WIDTH).
    ``reach`` is how many lags each series may use, by the order and the long autoregression
    together."""
    size = len(table)
    usable = (count >= 1) & np.isfinite(table).all((1, 2))
    table = np.where(usable[:, None, None], table, np.eye(WIDTH))
    reach = np.broadcast_to(reach, size)
    most = reach * MAX_TERMS // LAGS
    # lags beyond a series' own long order have no weight in its table
    lag = np.arange(WIDTH) - 1
    within = (lag <= (reach - most)[:, None]) | (lag > LONG_ORDER)
    long, _ = _solve(table * within[:, :, None] * within[:, None, :], [0, *range(2, 2 + LONG_ORDER)], 1)
    # new columns: 1, value, lags 1..5, residual lags 1..5, seasonal lag
    turn = np.zeros((size, 3 + 2 * MAX_TERMS, WIDTH))
    for i in range(2 + MAX_TERMS):
        turn[:, i, i] = 1
    for j in range(1, MAX_TERMS + 1):
        row = turn[:, 1 + MAX_TERMS + j]
        row[:, 1 + j] = 1
        row[:, 0] -= long[:, 0]
        row[:, 2 + j : 2 + j + LONG_ORDER] -= long[:, 1:]
    turn[:, -1, -1] = 1
    moments = turn @ table @ turn.transpose(0, 2, 1)

    best = {
        "aicc": np.full(size, np.inf),
        "sigma2": np.full(size, np.nan),
        "order": np.zeros((size, 3), int),
        # constant, lags, residual lags, seasonal lag
        "weights": np.zeros((size, 2 + 2 * MAX_TERMS)),
        "long": long,
    }
    for s in (0, 1):
        for p in range(MAX_TERMS + 1 - s):
            for q in range(MAX_TERMS + 1 - s - p):
                for const in (0, 1):
                    terms = [0] * const + [*range(2, 2 + p)]
                    terms += [*range(2 + MAX_TERMS, 2 + MAX_TERMS + q)]
                    terms += [2 + 2 * MAX_TERMS] * s
                    beta, sse = np.zeros((size, 0)), moments[:, 1, 1]
                    if terms:
                        beta, sse = _solve(moments, terms, 1)
                    k = len(terms) + 1
                    sse = np.maximum(sse, NEGLIGIBLE * count)
                    room = count - k - 1
                    with np.errstate(all="ignore"):
                        aicc = count * np.log(sse / count) + 2 * k + 2 * k * (k + 1) / room
                    able = usable & (room > 0) & np.isfinite(aicc) & (max(p, q) <= most)
                    if const:
                        able &= may_shift
                    if s:
                        able &= has_season
                    better = able & (aicc < best["aicc"] - 1e-9)
                    if not better.any():
                        continue
                    lags = np.zeros((size, max(p, season * s)))
                    lags[:, :p] = beta[:, const : const + p]
                    if s:
                        lags[:, season - 1] += beta[:, -1]
                    better &= _stable(lags) & _stable(-beta[:, const + p : const + p + q])
                    weights = np.zeros_like(best["weights"])
                    if const:
                        weights[:, 0] = beta[:, 0]
                    weights[:, 1 : 1 + p] = beta[:, const : const + p]
                    at = 1 + MAX_TERMS
                    weights[:, at : at + q] = beta[:, const + p : const + p + q]
                    if s:
                        weights[:, -1] = beta[:, -1]
                    best["aicc"][better] = aicc[better]
                    best["sigma2"][better] = sse[better] / count[better]
                    best["order"][better] = (p, q, s)
                    best["weights"][better] = weights[better]
    return best


FIT_TYPE = (
    "p int, q int, ps int, weights array<double>, long_run array<double>, "
    "sigma2 double, aicc double, fallback boolean"
)


def _fit_udf(season: int):
    @F.pandas_udf(FIT_TYPE)
    def fit(
        sums: pd.Series,
        count: pd.Series,
        has_season: pd.Series,
        may_shift: pd.Series,
        reach: pd.Series,
    ) -> pd.DataFrame:
        upper = np.triu_indices(WIDTH)
        table = np.zeros((len(sums), WIDTH, WIDTH))
        table[:, upper[0], upper[1]] = np.stack(sums.to_numpy())
        table[:, upper[1], upper[0]] = table[:, upper[0], upper[1]]
        best = choose_orders(
            table,
            count.to_numpy(float),
            has_season.to_numpy(bool),
            may_shift.to_numpy(bool),
            season,
            reach.to_numpy(int),
        )
        found = np.isfinite(best["aicc"])
        return pd.DataFrame(
            {
                "p": best["order"][:, 0],
                "q": best["order"][:, 1],
                "ps": best["order"][:, 2],
                "weights": list(best["weights"]),
                "long_run": list(best["long"]),
                "sigma2": best["sigma2"],
                "aicc": np.where(found, best["aicc"], np.nan),
                "fallback": ~found,
            }
        )

    return fit


def fit_models(
    series: DataFrame,
    keys: list[str] | None = None,
    targets: dict[str, str] | None = None,
    season: int = 52,
    partitions: int | None = None,
) -> DataFrame:
    """One fitted model per series and target, with what a forecast needs.

    Rows are hashed by series once; windows, sums and the fit keep that partitioning. A
    series that is constant, or has fewer than four values, gets its mean and the flag
    ``fallback``.
    """
    keys = keys or SERIES_KEYS
    by = [*keys, "target"]
    # windows hash the rows themselves, and adaptive execution keeps at least as many tasks
    # as cores; stacking forgets how rows were hashed, so a stated number comes after it
    long = stack_targets(series, keys, targets or TARGETS)
    if partitions:
        long = spread_by_keys(long, keys, partitions)
    sums = product_sums(difference(long, by, season), by, season)
    may_shift = F.col("d") + F.col("sd") <= 1
    fitted = sums.withColumn(
        "fit", _fit_udf(season)("sums", "rows_used", "has_season", may_shift, "reach")
    ).drop("sums")
    flat = ~(F.col("scale") > NEGLIGIBLE * F.greatest(F.abs("centre"), F.lit(1.0)))
    plain = flat | F.col("fit.fallback") | (F.col("n") < FEWEST)
    return fitted.withColumns(
        {
            "fallback": plain,
            "d": F.when(plain, 0).otherwise(F.col("d")),
            "sd": F.when(plain, 0).otherwise(F.col("sd")),
            "weights": F.when(
                plain, F.array_repeat(F.lit(0.0), 2 + 2 * MAX_TERMS)
            ).otherwise(F.col("fit.weights")),
        }
    )


def model_table(models: DataFrame, keys: list[str] | None = None, season: int = 52) -> DataFrame:
    """Orders (p, d, q, P, D, m) and coefficients on the scale of the data: constant, lags,
    residual lags, seasonal lag."""
    keys = keys or SERIES_KEYS
    w = F.col("weights")

    def order(c):
        return F.when(F.col("fallback"), 0).otherwise(F.col(c))

    carried = F.aggregate(
        F.concat(F.slice(w, 2, MAX_TERMS), F.slice(w, 2 + 2 * MAX_TERMS, 1)),
        F.lit(0.0),
        lambda acc, v: acc + v,
    )
    level = F.when(F.col("d") + F.col("sd") == 0, F.col("centre") * (1 - carried)).otherwise(0.0)
    constant = w[0] * F.col("scale") + level
    return models.select(
        *keys,
        "target",
        F.array(
            order("fit.p"), "d", order("fit.q"), order("fit.ps"), "sd", F.lit(season)
        ).alias("model_order"),
        F.concat(F.array(constant), F.slice(w, 2, 1 + 2 * MAX_TERMS)).alias("coefficients"),
        F.when(F.col("fallback"), F.col("scale") * F.col("scale"))
        .otherwise(F.col("fit.sigma2") * F.col("scale") * F.col("scale"))
        .alias("sigma2"),
        F.when(~F.col("fallback"), F.col("fit.aicc")).alias("aicc"),
        F.col("n").cast("int").alias("n_obs"),
        "fallback",
    )


def carry(
    models: DataFrame, weekly: DataFrame, keys: list[str] | None = None, season: int = 52
) -> DataFrame:
    """Stored models moved on over the weeks after their last one, without a new fit: new
    values are differenced with those kept, orders and weights stay. Series without new rows,
    and rows of series without a model, change nothing."""
    keys = keys or SERIES_KEYS
    by = [*keys, "target"]
    names = {t: c for t, c in TARGETS.items() if c in weekly.columns}
    ends = models.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("last_date").alias("_last"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    later = stack_targets(weekly, keys, names).join(ends, same).where("date > _last")
    new = later.groupBy(*[f"_{c}" for c in by]).agg(
        F.sort_array(F.collect_list(F.struct("date", "y"))).alias("_new")
    )
    kept = max(season, LAGS) + 1
    step = f"""transform(transform(array((r.y - centre) / IF(scale > 0, scale, 1D)),
        x -> named_struct('x', x, 'z', x - IF(sd = 1, coalesce(get(s, {season - 1}).x, 0D), 0D))),
        v -> named_struct('t', s[0].t + 1, 'w', CASE d WHEN 0 THEN v.z
            WHEN 1 THEN v.z - coalesce(get(s, 0).z, 0D)
            ELSE v.z - 2 * coalesce(get(s, 0).z, 0D) + coalesce(get(s, 1).z, 0D) END,
          'z', v.z, 'x', v.x))"""
    tail = F.expr(f"aggregate(coalesce(_new, array()), tail, (s, r) -> slice(concat({step}, s), 1, {kept}))")
    found = models.join(new, same, "left").withColumns(
        {
            "tail": tail,
            "last_date": F.coalesce(F.array_max("_new.date"), F.col("last_date")),
            "n": F.col("n") + F.coalesce(F.size("_new"), F.lit(0)),
        }
    )
    return found.select(*models.columns)


def project(models: DataFrame, horizon: int, season: int = 52) -> DataFrame:
    """Add ``path``, the values of the steps ahead, as an array.

    A fold over the steps: histories are arrays, newest first, and each step puts one
    value in front. Differences are undone within the step.
    """

    check_horizon(horizon)

    def past(name):
        return f"transform(tail, r -> coalesce(r.{name}, 0D))"

    def residual(j):
        own = f"get(_w, {j}) - get(fit.long_run, 0)"
        lags = [f"get(fit.long_run, {i}) * get(_w, {j + i})" for i in range(1, LONG_ORDER + 1)]
        return "coalesce(" + " - ".join([own, *lags]) + ", 0D)"

    terms = ["get(weights, 0)"]
    for i in range(1, MAX_TERMS + 1):
        terms.append(f"coalesce(get(weights, {i}) * get(s.w, {i - 1}), 0D)")
        # the residual i steps before step k is known only if it lies in the past
        terms.append(f"IF({i} >= k, get(weights, {MAX_TERMS + i}) * get(_e, {i} - k), 0D)")
    terms.append(f"coalesce(get(weights, {1 + 2 * MAX_TERMS}) * get(s.w, {season - 1}), 0D)")
    back = "CASE d WHEN 1 THEN get(s.z, 0) WHEN 2 THEN 2 * get(s.z, 0) - get(s.z, 1) ELSE 0D END"
    year_ago = f"IF(sd = 1, get(s.x, {season - 1}), 0D)"
    step = f"transform(array({' + '.join(terms)}), v -> named_struct('v', v, 'l', v + {back}))[0]"
    put = f"""transform(array({step}), n -> named_struct(
        'w', concat(array(n.v), s.w),
        'z', concat(array(n.l), s.z),
        'x', concat(array(n.l + {year_ago}), s.x)))[0]"""
    ahead = F.expr(f"""aggregate(
        sequence(1, {horizon}),
        named_struct('w', _w, 'z', _z, 'x', _x),
        (s, k) -> {put},
        s -> reverse(slice(s.x, 1, {horizon})))""")
    models = models.withColumns({f"_{c}": F.expr(past(c)) for c in ("w", "z", "x")})
    models = models.withColumn("_e", F.expr(f"array({', '.join(map(residual, range(MAX_TERMS)))})"))
    real = F.transform(ahead, lambda v: F.col("centre") + F.col("scale") * v)
    return models.withColumn("path", real).drop("_w", "_z", "_x", "_e")


def target_paths(
    models: DataFrame, horizon: int, season: int, keys: list[str], targets: dict[str, str]
) -> DataFrame:
    """One row per series with its last date and an array of values per target."""
    paths = project(models, horizon, season)
    return paths.groupBy(*keys).agg(
        F.max("last_date").alias("last_date"),
        *[
            F.max(F.when(F.col("target") == t, F.col("path"))).alias(t) for t in targets
        ],
    )


def forecast_weekly(
    weekly: DataFrame,
    horizon: int = 18,
    season: int = 52,
    first_step: str = "last",
    keys: list[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Weekly forecasts of sales and volume for every series.

    A lag is the previous observed week; ``fill_gaps`` beforehand makes it the calendar week.
    """
    models = fit_models(weekly, keys, season=season, partitions=partitions)
    return weekly_steps(models, horizon, season, first_step, keys)


def weekly_steps(
    models: DataFrame,
    horizon: int = 18,
    season: int = 52,
    first_step: str = "last",
    keys: list[str] | None = None,
) -> DataFrame:
    """The weekly forecasts of fitted models."""
    keys = keys or SERIES_KEYS
    shift = step_shift(first_step)
    paths = target_paths(models, horizon, season, keys, TARGETS)
    steps = paths.select(*keys, "last_date", F.posexplode(F.arrays_zip("sales", "volume")))
    return steps.select(
        *keys,
        F.date_add("last_date", F.col("pos") * 7 + shift).alias("Date"),
        F.col("col.volume").alias("forecast_volume"),
        F.col("col.sales").alias("fc_sales"),
    )


def monthly_sales(sales: DataFrame, date: str = "date", by: str = "store_number") -> DataFrame:
    """Sums per store and calendar month, dated at the first of the month."""
    return sales.groupBy(by, F.trunc(date, "month").alias("date")).agg(
        total_or_zero("sale_dollars").alias("total_sales"),
        total_or_zero("volume_sold_liters").alias("total_volume_sold"),
    )


def forecast_store_monthly(
    sales: DataFrame, horizon: int = 12, season: int = 12, date: str = "date"
) -> DataFrame:
    """Monthly forecasts of both measures per store, from sales lines with parsed dates."""
    keys = ["store_number"]
    models = fit_models(monthly_sales(sales, date), keys, season=season)
    paths = target_paths(models, horizon, season, keys, TARGETS)
    steps = paths.select(*keys, "last_date", F.posexplode(F.arrays_zip("sales", "volume")))
    return steps.select(
        *keys,
        F.add_months("last_date", F.col("pos") + 1).alias("Date"),
        F.col("col.volume").alias("forecast_volume"),
        F.col("col.sales").alias("fc_sales"),
    )
