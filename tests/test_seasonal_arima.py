import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfweek.operators import arima, backtest, seasonal_arima
from tests import brute_seasonal as brute

SEASON = 7


def made(n, season, ar=(), ma=(), seasonal=(0.0, 0.0), level=0.0, seed=0):
    rng = np.random.default_rng(seed)
    model = (0.0, [*ar, *[0.0] * 5][:5], [*ma, *[0.0] * 5][:5], list(seasonal))
    values, residuals = brute.lags_of(len(ar), len(ma), *model[1:], season)
    e, w = rng.normal(size=n + 100), np.zeros(n + 100)
    for t in range(n + 100):
        w[t] = e[t] + sum(v * w[t - j] for j, v in values.items() if t >= j)
        w[t] += sum(v * e[t - j] for j, v in residuals.items() if t >= j)
    return level + w[-n:]


SHAPES = [
    (made(90, SEASON, (0.6,), (0.5,), seed=1), True),
    (made(120, SEASON, (0.5,), (), (0.6, 0.0), seed=2), True),
    (made(120, SEASON, (), (0.6,), (0.0, 0.7), seed=3), False),
    (made(110, SEASON, (0.3, 0.3), (0.4,), (0.5, 0.5), seed=4), True),
    (made(16, SEASON, (0.5,), seed=5), True),
    (made(6, SEASON, seed=6), True),
    (np.zeros(0), True),
    (made(2, SEASON, seed=7), False),
]


def test_orders_weights_and_rounds_equal_brute_force():
    scaled = [(w - w.mean()) / w.std() if len(w) > 2 else w for w, _ in SHAPES]
    found = seasonal_arima.fit_batch(scaled, np.array([m for _, m in SHAPES]), SEASON)
    kinds = set()
    for w, (_, may), got in zip(scaled, SHAPES, found):
        want = brute.fit(w, may, SEASON)
        if want is None:
            assert got["fallback"]
            continue
        order, model, e, mean, score = want
        assert (got["p"], got["q"], got["sp"], got["sq"]) == order[:4]
        kinds.add(order[2:4])
        assert got["constant"] == pytest.approx(model[0], abs=1e-5)
        for name, own in (("ar", model[1]), ("ma", model[2]), ("seasonal", model[3])):
            assert got[name] == pytest.approx(np.array(own), abs=1e-5), name
        assert got["aicc"] == pytest.approx(score, abs=1e-5)
        assert got["sigma2"] == pytest.approx(mean, rel=1e-5)
        tail = [*e[::-1], *[0.0] * (SEASON + 5)][: SEASON + 5]
        assert got["e"] == pytest.approx(np.array(tail), abs=1e-4)
    assert {(0, 0), (1, 0), (0, 1)} <= kinds


def test_series_of_a_batch_do_not_touch_each_other():
    scaled = [w for w, _ in SHAPES]
    may = np.array([m for _, m in SHAPES])
    together = seasonal_arima.fit_batch(scaled, may, SEASON)
    for k, w in enumerate(scaled):
        alone = seasonal_arima.fit_batch([w], may[k : k + 1], SEASON)[0]
        for name, value in together[k].items():
            assert value == pytest.approx(alone[name], abs=1e-7, nan_ok=True), (k, name)


@pytest.mark.parametrize(
    "order, shape",
    [
        ((1, 1, 0, 0, 0), {"ar": (0.6,), "ma": (0.5,)}),
        ((1, 1, 1, 1, 0), {"ar": (0.5,), "ma": (0.4,), "seasonal": (0.5, 0.4)}),
        ((0, 1, 0, 1, 0), {"ma": (-0.6,), "seasonal": (0.0, -0.5)}),
    ],
)
def test_rounds_come_closer_to_the_weights_that_made_the_series(order, shape):
    values = [made(300, 12, seed=100 + k, **shape) for k in range(60)]
    batch = seasonal_arima.Batch([v / v.std() for v in values], 12)
    weights = seasonal_arima.Weights(60, order)
    weights.improve(batch.moments(batch.first_residuals()), seasonal_arima.TURNS)
    true = np.array([*shape.get("ar", (0,)), *shape["ma"], *shape.get("seasonal", (0, 0))])

    def off():
        own = np.concatenate([weights.ar[:, :1], weights.ma[:, :1], weights.seasonal], 1)
        return np.sqrt(((own - true) ** 2).mean())

    one = off()
    seasonal_arima.refine(batch, weights)
    assert off() < 0.97 * one


def sold(spark, series, end=dt.date(2022, 8, 28)):
    rows = []
    for (store, category, number), values in series.items():
        for back, v in enumerate(reversed(list(values))):
            rows.append((store, end - dt.timedelta(7 * back), category, float(v), 2 * float(v), number))
    return spark.createDataFrame(
        rows,
        "store_number int, date date, category_name string, total_sales double, total_volume_sold double, srl_num int",
    )


def forecasts(df):
    out = {}
    for r in df.orderBy("Date").collect():
        out.setdefault(r.srl_num, []).append(r.fc_sales)
    return out


@pytest.fixture(scope="module")
def series():
    made_up = {(k, "a", k): 100 + 5 * w for k, (w, _) in enumerate(SHAPES) if len(w)}
    made_up[(20, None, 20)] = np.cumsum(made(100, SEASON, (0.4,), seed=9)) + 50
    made_up[(21, "a", 21)] = np.full(30, 4.0)
    return made_up


def test_forecasts_equal_brute_force(spark, series):
    weekly = sold(spark, series)
    models = seasonal_arima.fit_models(weekly, season=SEASON)
    found = forecasts(seasonal_arima.weekly_steps(models, 9, SEASON))
    orders = {
        r.srl_num: (r.d, r.sd)
        for r in arima.difference_orders(weekly, season=SEASON).where("target = 'sales'").collect()
    }
    checked = 0
    for (_, _, number), y in series.items():
        d, sd = orders[number]
        y = np.asarray(y, float)
        if len(y) < 4 or y.std() < 1e-9:
            assert found[number] == pytest.approx([y.mean()] * 9)
            continue
        x = (y - y.mean()) / y.std()
        z = x[SEASON:] - x[:-SEASON] if sd else x
        w = np.diff(z, d) if d else z
        fitted = brute.fit(w, d + sd <= 1, SEASON)
        if fitted is None:
            continue
        order, model, e, _, _ = fitted
        steps = brute.ahead(w, order, model, e, 9, SEASON)
        for _ in range(d):
            last = np.diff(z, d - 1)[-1] if d > 1 else z[-1]
            steps, d = last + np.cumsum(steps), d - 1
        if sd:
            grown = list(x)
            for v in steps:
                grown.append(v + grown[-SEASON])
            steps = np.array(grown[len(x) :])
        assert found[number] == pytest.approx(y.mean() + y.std() * np.asarray(steps), rel=1e-4, abs=1e-3), number
        checked += 1
    assert checked >= 5 and {sd for _, sd in orders.values()} | {d for d, _ in orders.values()} >= {0, 1}


def test_carried_models_follow_new_weeks_without_a_fit(spark, series):
    whole = sold(spark, series)
    cut = dt.date(2022, 8, 28) - dt.timedelta(7 * 11)
    models = seasonal_arima.fit_models(whole.filter(F.col("date") <= cut), season=SEASON)
    models = spark.createDataFrame(models.collect(), models.schema)
    still = seasonal_arima.carry(models, whole.filter(F.col("date") <= cut), season=SEASON)
    assert sorted(map(str, still.collect())) == sorted(map(str, models.collect()))

    at_once = seasonal_arima.carry(models, whole, season=SEASON)
    assert at_once.schema.simpleString() == models.schema.simpleString()
    between = cut + dt.timedelta(7 * 4)
    stepwise = seasonal_arima.carry(models, whole.filter(F.col("date") <= between), season=SEASON)
    stepwise = seasonal_arima.carry(stepwise, whole, season=SEASON)
    key = lambda r: (r.store_number, r.target)
    for a, b in zip(sorted(at_once.collect(), key=key), sorted(stepwise.collect(), key=key)):
        for name in ("w", "z", "x", "e"):
            assert a[name] == pytest.approx(b[name], abs=1e-9)
        assert (a.last_date, a.n) == (b.last_date, b.n) == (dt.date(2022, 8, 28), a.n)

    # one series by hand: filter all its values with the weights of the stored model
    one = next(r for r in models.where("srl_num = 0 AND target = 'sales'").collect())
    assert (one.d, one.sd) == (0, 0)
    y = np.asarray(series[(0, "a", 0)])
    x = (y - one.centre) / one.scale
    model = (one.constant, one.ar, one.ma, one.seasonal)
    order = (one.p, one.q, one.sp, one.sq, 0)
    e = brute.filtered(x, order, model, SEASON)
    steps = brute.ahead(x, order, model, e, 6, SEASON)
    got = forecasts(seasonal_arima.weekly_steps(at_once.where("srl_num = 0"), 6, SEASON))[0]
    assert got == pytest.approx(one.centre + one.scale * np.array(steps), rel=1e-6)


def test_holes_nulls_and_infinities(spark, series):
    weekly = sold(spark, series)
    bad = weekly.limit(1).select("store_number", "category_name", "srl_num")
    extra = bad.selectExpr(
        "store_number", "CAST(NULL AS DATE) AS date", "category_name", "1D AS total_sales", "2D AS total_volume_sold", "srl_num"
    ).union(
        bad.selectExpr(
            "99", "DATE '2022-08-28'", "category_name", "double('inf')", "double('nan')", "99"
        )
    )
    a = forecasts(seasonal_arima.forecast_weekly(weekly, 5, SEASON))
    b = forecasts(seasonal_arima.forecast_weekly(weekly.unionByName(extra), 5, SEASON))
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k])
    assert seasonal_arima.forecast_weekly(weekly.limit(0), 5).collect() == []
    table = seasonal_arima.model_table(seasonal_arima.fit_models(weekly, season=SEASON), season=SEASON).collect()
    assert len(table) == 2 * len(series) and all(len(r.model_order) == 7 and len(r.coefficients) == 13 for r in table)


def test_held_out_weeks(spark, series):
    weekly = sold(spark, series)
    found = backtest.holdout_errors(weekly, {"seasonal": seasonal_arima, "additive": arima}, 4, SEASON)
    rows = {(r.srl_num, r.target): r for r in found.collect()}
    assert {n for n, _ in rows} == {n for (_, _, n), y in series.items() if len(y) >= 8}
    for (store, category, n), y in series.items():
        if len(y) < 8:
            continue
        y = np.asarray(y, float)
        left, held = y[:-4], y[-4:]
        own = rows[n, "sales"]
        assert own.n_weeks == 4
        assert own.mae_naive == pytest.approx(np.abs(held - left[-1]).mean())
        ago = left[-SEASON:][:4] if len(left) >= SEASON else np.full(4, left[-1])
        assert own.mae_seasonal_naive == pytest.approx(np.abs(held - ago).mean())
        fitted = forecasts(
            seasonal_arima.forecast_weekly(sold(spark, {(store, category, n): left}), 4, SEASON)
        )[n] if n in (0, 20) else None
        if fitted:
            assert own.mae_seasonal == pytest.approx(np.abs(held - fitted).mean(), rel=1e-6)
        assert rows[n, "volume"].mae_naive == pytest.approx(2 * own.mae_naive)
