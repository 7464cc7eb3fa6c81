"""ARIMA with seasonal polynomials, estimated in rounds.

A model is (1 - a(B)) (1 - A B^s) w = c + (1 + b(B)) (1 + M B^s) e, w being the differenced
series: short polynomials of up to five lags multiplied by seasonal ones. Differences, their
orders and the order of rows are worked out in Spark (``arima.difference``), which hands over
one array per series and measure; a series has at most one row per week. An Arrow function
then works on many series at once:

1. a long autoregression gives first residuals;
2. the products of short and seasonal lags of values and residuals are summed up per series.
   For given seasonal weights the short ones follow by least squares, and the other way
   round: both steps in turn, from the sums alone, for every order; AICc picks one;
3. the residuals are filtered anew with the chosen model, the sums taken again and the
   weights estimated again, until they settle or the sum of squares falls no more.

Forecasts are an array fold in Spark. A fitted model is a row with all it needs: it can be
stored, read back, carried over new weeks by ``carry`` and projected without a new fit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweek.functions.dates import check_horizon
from shelfweek.operators.arima import (
    FEWEST,
    LAGS,
    LONG_ORDER,
    MAX_TERMS,
    NEGLIGIBLE,
    ROOT_LIMIT,
    _solve,
    _stable,
    difference,
    stack_targets,
)
from shelfweek.operators.series import spread_by_keys, step_shift
from shelfweek.schemas import SERIES_KEYS, TARGETS

# fixed values: turns of the two least-squares steps, and rounds of new residuals
TURNS = 3
ROUNDS = 10
SETTLED = 1e-6
#: Series worked on at once; the tables of their lags are held together.
AT_ONCE = 256

# columns of the sums: 1, value and its short lags, short lags of the residual, and the
# seasonal lag of each with the short lags after it
W, E, WS, ES = 1, 2 + MAX_TERMS, 2 + 2 * MAX_TERMS, 3 + 3 * MAX_TERMS
COLUMNS = 4 + 4 * MAX_TERMS


def _lag(a: np.ndarray, j: int) -> np.ndarray:
    out = np.zeros_like(a)
    if j < a.shape[1]:
        out[:, j:] = a[:, : a.shape[1] - j]
    return out


class Batch:
    """Series of one batch, ending together, zeros before their start."""

    def __init__(self, values: list[np.ndarray], season: int):
        self.season = season
        self.size = np.array([len(v) for v in values])
        self.n = int(self.size.max(initial=1))
        self.w = np.zeros((len(values), self.n))
        for k, v in enumerate(values):
            self.w[k, self.n - len(v) :] = v
        self.place = np.arange(self.n) - (self.n - self.size)[:, None]
        # seasonal terms cost a season of rows and some
        self.has_season = (self.size >= 2 * season + LAGS) & (season > MAX_TERMS)
        self.reach = np.minimum(LAGS, np.maximum(0, (self.size - 3) // 2))
        self.most = self.reach * MAX_TERMS // LAGS
        burn = np.where(self.has_season, season + MAX_TERMS, self.reach)
        self.shared = self.place >= burn[:, None]
        self.count = self.shared.sum(1).astype(float)

    def part(self, rows: np.ndarray) -> Batch:
        own = object.__new__(Batch)
        own.season, own.n = self.season, self.n
        for name in ("size", "w", "place", "has_season", "reach", "most", "shared", "count"):
            setattr(own, name, getattr(self, name)[rows])
        return own

    def sums(self, columns: np.ndarray) -> np.ndarray:
        kept = np.where(self.shared[:, :, None], columns, 0.0)
        return kept.transpose(0, 2, 1) @ kept

    def first_residuals(self) -> np.ndarray:
        """Of an autoregression on as many lags as the series bears, and on the season."""
        lags = [*range(1, LONG_ORDER + 1), self.season, self.season + 1]
        columns = np.stack([np.ones_like(self.w), self.w, *[_lag(self.w, j) for j in lags]], 2)
        own = np.array(lags) <= (self.reach - self.most)[:, None]
        own[:, LONG_ORDER:] = self.has_season[:, None]
        columns[:, :, 2:] *= own[:, None, :]
        beta, _ = _solve(self.sums(columns), [0, *range(2, 2 + len(lags))], 1)
        fitted = beta[:, None, 0] + (columns[:, :, 2:] * beta[:, None, 1:]).sum(2)
        known = self.place >= np.where(self.has_season, self.season + 1, self.reach - self.most)[:, None]
        return np.where(known, self.w - fitted, 0.0)

    def moments(self, e: np.ndarray) -> np.ndarray:
        """Sums of products of all columns, for residuals ``e``."""
        short = range(MAX_TERMS + 1)
        columns = [np.ones_like(self.w)]
        columns += [_lag(self.w, j) for j in short]
        columns += [_lag(e, j) for j in short[1:]]
        for a in (self.w, e):
            columns += [_lag(a, self.season + j) * self.has_season[:, None] for j in short]
        return self.sums(np.stack(columns, 2))

    def residuals(self, model: Weights) -> np.ndarray:
        """Filtered from the first place where all lags of the value are there."""
        lags = model.lags(self.season)
        own = self.w - model.constant[:, None]
        for j, weight in zip(lags, model.expanded("ar").T):
            if weight.any():
                own = own - weight[:, None] * _lag(self.w, j)
        longest = np.where(model.seasonal[:, 0] != 0, self.season, 0) + model.order[0]
        own = np.where(self.place >= longest[:, None], own, 0.0)
        moving = model.expanded("ma")
        lags = [j for j, weight in zip(lags, moving.T) if weight.any()]
        moving = moving[:, moving.any(0)]
        if not lags:
            return own
        out = np.zeros((len(own), self.n + max(lags)))
        shift = max(lags) - np.array(lags)
        started = self.place >= longest[:, None]
        for t in range(self.n):
            past = (moving * out[:, t + shift]).sum(1)
            out[:, t + max(lags)] = np.where(started[:, t], own[:, t] - past, 0.0)
        return out[:, max(lags) :]


class Weights:
    """Weights of one order for some series: constant, short and seasonal ones."""

    def __init__(self, n: int, order: tuple[int, int, int, int, int]):
        self.order = order
        self.constant = np.zeros(n)
        self.ar, self.ma = np.zeros((n, MAX_TERMS)), np.zeros((n, MAX_TERMS))
        self.seasonal = np.zeros((n, 2))

    @staticmethod
    def lags(season: int) -> list[int]:
        return [*range(1, MAX_TERMS + 1), *range(season, season + MAX_TERMS + 1)]

    def expanded(self, kind: str) -> np.ndarray:
        """Weights of the multiplied polynomial at ``lags``."""
        short = self.ar if kind == "ar" else self.ma
        seasonal = self.seasonal[:, [int(kind == "ma")]]
        both = short * seasonal * (-1 if kind == "ar" else 1)
        return np.concatenate([short, seasonal, both], 1)

    def residual_row(self) -> np.ndarray:
        """The residual as a sum of columns."""
        row = np.zeros((len(self.ar), COLUMNS))
        row[:, 0], row[:, W] = -self.constant, 1
        ar, ma = self.expanded("ar"), self.expanded("ma")
        row[:, W + 1 : E] = -ar[:, :MAX_TERMS]
        row[:, E:WS] = -ma[:, :MAX_TERMS]
        row[:, WS:ES] = -ar[:, MAX_TERMS:]
        row[:, ES:] = -ma[:, MAX_TERMS:]
        return row

    def squares(self, moments: np.ndarray) -> np.ndarray:
        row = self.residual_row()
        return np.einsum("si,sij,sj->s", row, moments, row)

    def improve(self, moments: np.ndarray, turns: int) -> None:
        """Short weights for the seasonal ones, seasonal for the short ones, in turn."""
        p, q, sp, sq, const = self.order
        n = len(self.ar)
        for turn in range(turns if sp or sq else 1):
            if turn:
                rows = np.zeros((n, 1 + sp + sq, COLUMNS))
                rows[:, 0, 0], rows[:, 0, W] = -self.constant, 1
                rows[:, 0, W + 1 : E], rows[:, 0, E:WS] = -self.ar, -self.ma
                if sp:
                    rows[:, 1, WS], rows[:, 1, WS + 1 : ES] = 1, -self.ar
                if sq:
                    rows[:, -1, ES], rows[:, -1, ES + 1 :] = 1, self.ma
                table = rows @ moments @ rows.transpose(0, 2, 1)
                beta, _ = _solve(table, list(range(1, 1 + sp + sq)), 0)
                self.seasonal[:, :sp] = beta[:, :sp]
                self.seasonal[:, 1 : 1 + sq] = beta[:, sp:]
            rows = np.zeros((n, 1 + const + p + q, COLUMNS))
            ahead, back = self.seasonal[:, 0], self.seasonal[:, 1]
            rows[:, 0, W], rows[:, 0, WS], rows[:, 0, ES] = 1, -ahead, -back
            if const:
                rows[:, 1, 0] = 1
            for i in range(p):
                rows[:, 1 + const + i, W + 1 + i], rows[:, 1 + const + i, WS + 1 + i] = 1, -ahead
            for j in range(q):
                at = 1 + const + p + j
                rows[:, at, E + j], rows[:, at, ES + 1 + j] = 1, back
            if const + p + q:
                table = rows @ moments @ rows.transpose(0, 2, 1)
                beta, _ = _solve(table, list(range(1, rows.shape[1])), 0)
                self.constant[:] = beta[:, 0] if const else 0.0
                self.ar[:, :p], self.ma[:, :q] = beta[:, const : const + p], beta[:, const + p :]

    def stable(self, season: int) -> np.ndarray:
        p, q = self.order[:2]
        ok = _stable(self.ar[:, :p].copy()) & _stable(-self.ma[:, :q])
        return ok & (np.abs(self.seasonal) * ROOT_LIMIT**season < 1).all(1)

    def rows(self, chosen: np.ndarray) -> Weights:
        own = Weights(0, self.order)
        for name in ("constant", "ar", "ma", "seasonal"):
            setattr(own, name, getattr(self, name)[chosen].copy())
        return own

    def put(self, chosen: np.ndarray, other: Weights) -> None:
        for name in ("constant", "ar", "ma", "seasonal"):
            getattr(self, name)[chosen] = getattr(other, name)


def orders(seasonal: bool) -> list[tuple[int, int, int, int, int]]:
    """(p, q, P, M, constant), few terms of the season first."""
    parts = range(2 if seasonal else 1)
    return [
        (p, q, sp, sq, const)
        for sp in parts
        for sq in parts
        for p in range(MAX_TERMS + 1 - sp - sq)
        for q in range(MAX_TERMS + 1 - sp - sq - p)
        for const in (0, 1)
    ]


def search(batch: Batch, may_shift: np.ndarray) -> tuple[list, np.ndarray, np.ndarray]:
    """Order and weights by AICc on the rows all orders share: per series its order (or None)
    and place in that order's weights."""
    moments = batch.moments(batch.first_residuals())
    usable = (batch.count >= 1) & np.isfinite(moments).all((1, 2))
    moments = np.where(usable[:, None, None], moments, np.eye(COLUMNS))
    best, chosen = np.full(len(moments), np.inf), [None] * len(moments)
    for order in orders(bool(batch.has_season.any())):
        p, q, sp, sq, const = order
        k = sum(order) + 1
        room = batch.count - k - 1
        able = usable & (room > 0) & (max(p, q) <= batch.most)
        able &= (may_shift | (const == 0)) & (batch.has_season | (sp + sq == 0))
        if not able.any():
            continue
        weights = Weights(len(moments), order)
        weights.improve(moments, TURNS)
        squares = np.maximum(weights.squares(moments), NEGLIGIBLE * batch.count)
        with np.errstate(all="ignore"):
            score = batch.count * np.log(squares / batch.count) + 2 * k + 2 * k * (k + 1) / room
        better = able & np.isfinite(score) & (score < best - 1e-9)
        if better.any():
            better &= weights.stable(batch.season)
        best[better] = score[better]
        for i in np.flatnonzero(better):
            chosen[i] = weights
    return chosen, best, moments


def refine(batch: Batch, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """New residuals, new sums, new weights, until they settle; ``weights`` are changed.
    The residuals and the mean of their squares over the shared rows."""

    def squares(e, own):
        return np.where(own.shared, e * e, 0.0).sum(1)

    residuals = batch.residuals(weights)
    least = squares(residuals, batch)
    going = np.arange(len(least)) if weights.order[1] or weights.order[3] else np.zeros(0, int)
    for _ in range(ROUNDS):
        if not len(going):
            break
        own, old = batch.part(going), weights.rows(going)
        new = old.rows(np.arange(len(going)))
        moments = own.moments(residuals[going])
        new.improve(moments, TURNS)
        fine = new.stable(batch.season) & np.isfinite(new.residual_row()).all(1)
        new.put(~fine, old.rows(~fine))
        filtered = own.residuals(new)
        found = squares(filtered, own)
        better = fine & np.isfinite(found) & (found < least[going])
        moved = np.abs(new.residual_row() - old.residual_row()).max(1) > SETTLED
        rows = going[better]
        weights.put(rows, new.rows(better))
        residuals[rows], least[rows] = filtered[better], found[better]
        going = going[better & moved]
    return residuals, least / np.maximum(batch.count, 1)


FIT_TYPE = (
    "p int, q int, sp int, sq int, constant double, ar array<double>, ma array<double>, "
    "seasonal array<double>, ar_full array<double>, ma_full array<double>, e array<double>, "
    "sigma2 double, aicc double, fallback boolean"
)


def _full(weights: np.ndarray, season: int) -> np.ndarray:
    out = np.zeros(season + MAX_TERMS)
    out[:MAX_TERMS] = weights[:MAX_TERMS]
    out[season - 1 :] += weights[MAX_TERMS:]
    return out


def fit_batch(values: list[np.ndarray], may_shift: np.ndarray, season: int) -> list[dict]:
    batch = Batch(values, season)
    chosen, aicc, _ = search(batch, may_shift)
    none = np.zeros(season + MAX_TERMS)
    out: list[dict] = [
        {"p": 0, "q": 0, "sp": 0, "sq": 0, "constant": 0.0, "ar": none[:MAX_TERMS]}
        | {"ma": none[:MAX_TERMS], "seasonal": none[:2], "ar_full": none, "ma_full": none}
        | {"e": none, "sigma2": np.nan, "aicc": np.nan, "fallback": True}
        for _ in values
    ]
    by_order: dict[int, list[int]] = {}
    for i, weights in enumerate(chosen):
        if weights is not None:
            by_order.setdefault(id(weights), []).append(i)
    for rows in map(np.array, by_order.values()):
        weights = chosen[rows[0]].rows(rows)
        residuals, mean = refine(batch.part(rows), weights)
        ar, ma = weights.expanded("ar"), weights.expanded("ma")
        tail = np.zeros((len(rows), season + MAX_TERMS))
        last = residuals[:, ::-1][:, : tail.shape[1]]
        tail[:, : last.shape[1]] = last
        for k, i in enumerate(rows):
            out[i] = dict(zip(("p", "q", "sp", "sq"), weights.order)) | {
                "constant": weights.constant[k],
                "ar": weights.ar[k],
                "ma": weights.ma[k],
                "seasonal": weights.seasonal[k],
                "ar_full": _full(ar[k], season),
                "ma_full": _full(ma[k], season),
                "e": tail[k],
                "sigma2": mean[k],
                "aicc": aicc[i],
                "fallback": False,
            }
    return out


def _fit_udf(season: int):
    @F.pandas_udf(FIT_TYPE)
    def fit(values: pd.Series, may_shift: pd.Series) -> pd.DataFrame:
        found = []
        for at in range(0, len(values), AT_ONCE):
            part = [np.asarray(v, float) for v in values[at : at + AT_ONCE]]
            found += fit_batch(part, may_shift[at : at + AT_ONCE].to_numpy(bool), season)
        return pd.DataFrame(found, columns=[f.split()[0] for f in FIT_TYPE.split(", ")])

    return fit


def fit_models(
    series: DataFrame,
    keys: list[str] | None = None,
    targets: dict[str, str] | None = None,
    season: int = 52,
    partitions: int | None = None,
) -> DataFrame:
    """One fitted model per series and target, with the state a forecast starts from: the
    last values at each stage of differencing and the last residuals, newest first.

    A series that is constant, or has fewer than four values, gets its mean and the flag
    ``fallback``. Missing and non-finite values are left out, as are rows without a date.
    """
    keys = keys or SERIES_KEYS
    by = [*keys, "target"]
    long = stack_targets(series, keys, targets or TARGETS)
    long = long.filter(F.abs("y") < float("inf"))
    if partitions:
        long = spread_by_keys(long, keys, partitions)
    rows = difference(long, by, season)
    nested = rows.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct("t", "w", "z", "x"))).alias("_rows"),
        F.max("date").alias("last_date"),
        *[F.max(c).alias(c) for c in ("n", "d", "sd", "centre", "scale")],
    )
    flat = ~(F.col("scale") > NEGLIGIBLE * F.greatest(F.abs("centre"), F.lit(1.0)))
    plain = flat | (F.col("n") < FEWEST)
    lost = F.col("sd") * season + F.col("d")
    own = F.when(plain, F.array().cast("array<double>")).otherwise(
        F.slice("_rows.w", (lost + 1).cast("int"), F.greatest(F.lit(0), F.col("n") - lost).cast("int"))
    )
    may_shift = F.col("d") + F.col("sd") <= 1
    fitted = nested.withColumn("fit", _fit_udf(season)(own, may_shift))

    def tail(name):
        last = F.slice(F.reverse(f"_rows.{name}"), 1, season + MAX_TERMS + 2)
        return F.transform(last, lambda v: F.coalesce(v, F.lit(0.0))).alias(name)

    nothing = F.col("fit.fallback")
    return fitted.select(
        *by,
        "last_date",
        F.col("n").cast("int").alias("n"),
        F.when(nothing, 0).otherwise(F.col("d")).cast("int").alias("d"),
        F.when(nothing, 0).otherwise(F.col("sd")).cast("int").alias("sd"),
        "centre",
        "scale",
        "fit.*",
        *[tail(c) for c in ("w", "z", "x")],
    )


def _dot(weights: str, values: str) -> str:
    return f"""aggregate(zip_with({weights}, slice({values}, 1, size({weights})),
        (a, v) -> coalesce(a * v, 0D)), 0D, (acc, v) -> acc + v)"""


def _known(value: str, season: int) -> str:
    """What a value on the scale of the data is at each stage of differencing, from the state
    ``s``; and the residual, which is known once the value is."""
    return f"""transform(transform(array({value}),
      x -> named_struct('x', x, 'z', x - IF(sd = 1, coalesce(get(s.x, {season - 1}), 0D), 0D))),
      v -> named_struct('x', v.x, 'z', v.z, 'w', CASE d WHEN 0 THEN v.z
        WHEN 1 THEN v.z - coalesce(get(s.z, 0), 0D)
        ELSE v.z - 2 * coalesce(get(s.z, 0), 0D) + coalesce(get(s.z, 1), 0D) END))[0]"""


def carry(models: DataFrame, weekly: DataFrame, keys: list[str] | None = None, season: int = 52) -> DataFrame:
    """Stored models moved on over the weeks after their last one, without a new fit: the
    state is filtered through the new values, orders and weights stay. Series without new
    rows, and rows of series without a model, change nothing. Rows without a date or a value
    are left out, as when fitting; a constant or short series keeps its mean."""
    keys = keys or SERIES_KEYS
    by = [*keys, "target"]
    names = {t: TARGETS[t] for t in TARGETS if TARGETS[t] in weekly.columns}
    long = stack_targets(weekly, keys, names).filter(F.abs("y") < float("inf"))
    later = [long[c].eqNullSafe(models[c]) for c in by]
    ends = models.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("last_date").alias("_last"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    later = long.join(ends, same).where(F.col("date") > F.col("_last"))
    new = later.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(
        F.sort_array(F.collect_list(F.struct("date", "y"))).alias("_new")
    )
    found = models.join(new, same, "left")
    kept = season + MAX_TERMS + 2
    put = f"""transform(array({_known('(r.y - centre) / IF(fallback, 1D, scale)', season)}), n -> named_struct(
        'w', slice(concat(array(n.w), s.w), 1, {kept}),
        'z', slice(concat(array(n.z), s.z), 1, {kept}),
        'x', slice(concat(array(n.x), s.x), 1, {kept}),
        'e', slice(concat(array(n.w - constant - {_dot('ar_full', 's.w')} - {_dot('ma_full', 's.e')}), s.e),
             1, {season + MAX_TERMS})))[0]"""
    state = F.expr(
        f"aggregate(coalesce(_new, array()), named_struct('w', w, 'z', z, 'x', x, 'e', e), (s, r) -> {put})"
    )
    found = found.withColumn("_state", F.when(F.col("fallback"), F.struct("w", "z", "x", "e")).otherwise(state))
    moved = {c: F.col(f"_state.{c}") for c in ("w", "z", "x", "e")}
    moved["last_date"] = F.coalesce(F.array_max("_new.date"), F.col("last_date"))
    moved["n"] = (F.col("n") + F.coalesce(F.size("_new"), F.lit(0))).cast("int")
    return found.withColumns(moved).select(*models.columns)


def project(models: DataFrame, horizon: int, season: int = 52) -> DataFrame:
    """Add ``path``, the values of the steps ahead, as an array."""
    check_horizon(horizon)
    back = "CASE d WHEN 1 THEN get(s.z, 0) WHEN 2 THEN 2 * get(s.z, 0) - get(s.z, 1) ELSE 0D END"
    year_ago = f"IF(sd = 1, get(s.x, {season - 1}), 0D)"
    value = f"constant + {_dot('ar_full', 's.w')} + {_dot('ma_full', 's.e')}"
    step = f"transform(array({value}), v -> named_struct('v', v, 'l', v + {back}))[0]"
    ahead = f"""aggregate(sequence(1, {horizon}), named_struct('w', w, 'z', z, 'x', x, 'e', e),
        (s, k) -> transform(array({step}), n -> named_struct(
            'w', concat(array(n.v), s.w), 'z', concat(array(n.l), s.z),
            'x', concat(array(n.l + {year_ago}), s.x), 'e', concat(array(0D), s.e)))[0],
        s -> reverse(slice(s.x, 1, {horizon})))"""
    real = F.transform(F.expr(ahead), lambda v: F.col("centre") + F.col("scale") * v)
    mean = F.array_repeat(F.col("centre"), horizon)
    return models.withColumn("path", F.when(F.col("fallback"), mean).otherwise(real))


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
    paths = project(models, horizon, season).groupBy(*keys).agg(
        F.max("last_date").alias("last_date"),
        *[F.max(F.when(F.col("target") == t, F.col("path"))).alias(t) for t in TARGETS],
    )
    steps = paths.select(*keys, "last_date", F.posexplode(F.arrays_zip(*TARGETS)))
    return steps.select(
        *keys,
        F.date_add("last_date", F.col("pos") * 7 + shift).alias("Date"),
        F.col("col.volume").alias("forecast_volume"),
        F.col("col.sales").alias("fc_sales"),
    )


def forecast_weekly(
    weekly: DataFrame,
    horizon: int = 18,
    season: int = 52,
    first_step: str = "last",
    keys: list[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Weekly forecasts of sales and volume for every series."""
    models = fit_models(weekly, keys, season=season, partitions=partitions)
    return weekly_steps(models, horizon, season, first_step, keys)


def model_table(models: DataFrame, keys: list[str] | None = None, season: int = 52) -> DataFrame:
    """Orders (p, d, q, P, D, Q, m) and coefficients on the scale of the data: constant, lags,
    residual lags, seasonal lag, seasonal residual."""
    keys = keys or SERIES_KEYS
    carried = F.aggregate("ar_full", F.lit(0.0), lambda acc, v: acc + v)
    level = F.when(F.col("d") + F.col("sd") == 0, F.col("centre") * (1 - carried)).otherwise(0.0)
    constant: Column = F.col("constant") * F.col("scale") + level
    spread = F.col("scale") * F.col("scale")
    return models.select(
        *keys,
        "target",
        F.array("p", "d", "q", "sp", "sd", "sq", F.lit(season)).alias("model_order"),
        F.concat(F.array(constant), "ar", "ma", "seasonal").alias("coefficients"),
        F.when(F.col("fallback"), spread).otherwise(F.col("sigma2") * spread).alias("sigma2"),
        F.when(~F.col("fallback"), F.col("aicc")).alias("aicc"),
        F.col("n").alias("n_obs"),
        "fallback",
    )
