import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfweek.operators import arima, simple_forecast
from tests import brute_arima

SEASON = 12
HORIZON = 18


def noise(seed, n):
    return np.random.default_rng(seed).normal(size=n)


def filtered(e, ar=(), ma=()):
    y = np.zeros(len(e))
    for t in range(len(e)):
        y[t] = e[t]
        y[t] += sum(a * y[t - i] for i, a in enumerate(ar, 1) if t >= i)
        y[t] += sum(b * e[t - i] for i, b in enumerate(ma, 1) if t >= i)
    return y


def fleet():
    n = 150
    t = np.arange(n)
    wave = np.sin(2 * np.pi * t / SEASON)
    return {
        "white": 100 + noise(1, n),
        "ar1": 50 + filtered(noise(2, n), [0.7]),
        "negative ar1": 50 + filtered(noise(3, n), [-0.8]),
        "ma1": 20 + filtered(noise(4, n), ma=[0.8]),
        "arma": 20 + filtered(noise(5, n), [0.6, -0.3], [0.4]),
        "walk": 200 + np.cumsum(noise(6, n)),
        "walk with drift": 200 + np.cumsum(0.8 + 0.3 * noise(7, n)),
        "twice summed": np.cumsum(np.cumsum(0.1 * noise(8, n))),
        "wave": 10 + 5 * wave + 0.3 * noise(9, n),
        "wave and trend": 10 + 5 * wave + 0.2 * t + 0.3 * noise(10, n),
        "seasonal ar": 10 + filtered(noise(11, n), [0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0.6]),
        "short": 30 + noise(12, 40),
        "twenty": 30 + filtered(noise(14, 20), [0.8]),
        "nine": 30 + noise(15, 9),
        "six": 30 + 3 * np.arange(6) + noise(16, 6),
        "large level": 1e6 + 10 * filtered(noise(13, n), [0.5]),
    }


@pytest.fixture(scope="module")
def names():
    return {i: name for i, name in enumerate(fleet(), 1)}


@pytest.fixture(scope="module")
def weekly(weekly_of):
    return weekly_of({(i, name, i): y for i, (name, y) in enumerate(fleet().items(), 1)}).cache()


def by_series(forecasts):
    out = {}
    for r in forecasts.orderBy("srl_num", "Date").collect():
        out.setdefault(r["srl_num"], []).append((r["Date"], r["fc_sales"], r["forecast_volume"]))
    return out


def test_orders_and_values_equal_row_by_row_search(weekly, names):
    models = arima.model_table(arima.fit_models(weekly, season=SEASON), season=SEASON)
    orders = {
        r["srl_num"]: tuple(r["model_order"]) for r in models.filter("target = 'sales'").collect()
    }
    got = by_series(arima.forecast_weekly(weekly, HORIZON, SEASON))
    for number, (name, y) in zip(names, fleet().items()):
        order, values = brute_arima.forecast(y, SEASON, HORIZON)
        p, d, q, s, sd = order
        assert orders[number] == (p, d, q, s, sd, SEASON), name
        ours = np.array([v for _, v, _ in got[number]])
        assert np.allclose(ours, values, rtol=1e-5, atol=1e-5 * y.std()), name


def test_both_measures_follow_the_same_rules(weekly):
    # the volume is a tenth of the sales, so its forecasts are a tenth as well
    for steps in by_series(arima.forecast_weekly(weekly, HORIZON, SEASON)).values():
        sales = np.array([s for _, s, _ in steps])
        volume = np.array([v for _, _, v in steps])
        assert np.allclose(sales, 10 * volume, rtol=1e-4, atol=1e-4 * np.abs(sales).max())


def test_every_series_gets_every_step_dated_from_its_last_week(weekly, names):
    got = by_series(arima.forecast_weekly(weekly, HORIZON, SEASON))
    assert set(got) == set(names)
    for steps in got.values():
        assert [d for d, _, _ in steps] == [
            dt.date(2022, 8, 28) + dt.timedelta(7 * k) for k in range(HORIZON)
        ]
        assert np.isfinite([[s, v] for _, s, v in steps]).all()
    later = by_series(arima.forecast_weekly(weekly, 2, SEASON, first_step="next"))
    assert later[1][0][0] == dt.date(2022, 9, 4) and len(later[1]) == 2


def test_row_order_and_partition_count_do_not_matter(weekly):
    a = by_series(arima.forecast_weekly(weekly, HORIZON, SEASON))
    shuffled = weekly.orderBy(F.rand(5)).repartition(7)
    b = by_series(arima.forecast_weekly(shuffled, HORIZON, SEASON, partitions=3))
    assert a.keys() == b.keys()
    for k in a:
        assert np.allclose([r[1:] for r in a[k]], [r[1:] for r in b[k]], rtol=1e-6, atol=1e-6)


@pytest.fixture(scope="module")
def special(weekly_of):
    t = np.arange(4 * 52)
    return weekly_of(
        {
            (1, "constant", 1): [5.0] * 80,
            (2, "line", 2): 3.0 + 2.0 * np.arange(80),
            (3, "sinusoid", 3): 100 + 10 * np.sin(2 * np.pi * t / 52),
            (4, "three weeks", 4): [1.0, 2.0, 6.0],
            (5, "one week", 5): [7.0],
            (6, "curve", 6): 0.5 * np.arange(90) ** 2,
            (7, "zero", 7): [0.0] * 60,
        }
    ).cache()


def test_exact_shapes_are_continued(special):
    got = by_series(arima.forecast_weekly(special))
    k = np.arange(1, HORIZON + 1)
    want = {
        1: np.full(HORIZON, 5.0),
        2: 3.0 + 2.0 * (79 + k),
        3: 100 + 10 * np.sin(2 * np.pi * (4 * 52 - 1 + k) / 52),
        4: np.full(HORIZON, 3.0),
        5: np.full(HORIZON, 7.0),
        # two differences leave no room for a constant: the last step goes on
        6: 0.5 * 89**2 + 88.5 * k,
        7: np.zeros(HORIZON),
    }
    for number, values in want.items():
        assert np.allclose([v for _, v, _ in got[number]], values, rtol=1e-4, atol=1e-4), number


@pytest.mark.parametrize("n", [5, 12, 20, 26, 27, 28])
def test_short_lines_are_continued(weekly_of, n):
    line = weekly_of({(1, "line", 1): 10.0 * np.arange(1, n + 1)})
    values = [v for _, v, _ in by_series(arima.forecast_weekly(line, 4))[1]]
    assert np.allclose(values, 10.0 * np.arange(n + 1, n + 5), rtol=1e-4)


def test_only_fewer_than_four_values_or_a_constant_give_the_mean(weekly_of):
    rows = {(n, "x", n): 10 + noise(n, n) for n in range(1, 9)}
    models = arima.model_table(arima.fit_models(weekly_of(rows))).filter("target = 'sales'")
    assert {r["srl_num"] for r in models.filter("fallback").collect()} == {1, 2, 3}


def test_the_bandwidth_of_the_stationarity_test_has_no_limit(weekly_of):
    # near the critical value, so that a shorter bandwidth would decide otherwise
    y = filtered(noise(50, 1600), [0.97])
    (row,) = arima.difference_orders(weekly_of({(1, "a", 1): y}), season=52).filter(
        "target = 'sales'"
    ).collect()
    x = (y - y.mean()) / y.std()
    assert row["n"] == 1600 and row["sd"] == 0
    d = 0 if brute_arima.kpss(x) <= 0.463 else 1 if brute_arima.kpss(np.diff(x)) <= 0.463 else 2
    assert row["d"] == d


def test_stationarity_statistic_equals_the_sum_over_lags(spark):
    for n in (4, 30, 400, 1600, 4000):
        e = noise(n, n).cumsum()
        e -= e.mean()
        df = spark.createDataFrame([(e.tolist(),)], "e array<double>")
        (row,) = df.select(arima._kpss(F.col("e"), F.lit(float(n))).alias("k")).collect()
        assert row.k == pytest.approx(brute_arima.kpss(e), rel=1e-9)


def test_model_table_of_exact_shapes(special):
    rows = arima.model_table(arima.fit_models(special)).filter("target = 'sales'").collect()
    models = {r["srl_num"]: r for r in rows}
    assert {n for n, r in models.items() if r["fallback"]} == {1, 4, 5, 7}
    assert models[1]["coefficients"][0] == pytest.approx(5.0)
    assert models[1]["aicc"] is None and models[1]["model_order"] == [0, 0, 0, 0, 0, 52]
    assert models[2]["model_order"] == [0, 1, 0, 0, 0, 52]
    assert models[2]["coefficients"][0] == pytest.approx(2.0)
    assert models[3]["model_order"][4] == 1
    assert models[6]["model_order"][1] == 2
    assert models[3]["n_obs"] == 208 and len(models[3]["coefficients"]) == 12


def test_coefficients_come_near_the_truth(weekly_of):
    y = 500 + 40 * filtered(noise(21, 2000), [0.7])
    rows = arima.model_table(arima.fit_models(weekly_of({(1, "a", 1): y}), season=12)).collect()
    r = next(r for r in rows if r["target"] == "sales")
    p, d = r["model_order"][:2]
    assert d == 0 and p >= 1
    constant, lags = r["coefficients"][0], np.array(r["coefficients"][1:6])
    assert constant / (1 - lags.sum() - r["coefficients"][11]) == pytest.approx(y.mean(), rel=0.05)
    assert np.sqrt(r["sigma2"]) == pytest.approx(40, rel=0.1)


def test_closed_form_where_that_order_is_chosen(weekly, special):
    line = special.filter("srl_num = 2")
    a = by_series(arima.forecast_weekly(line))[2]
    b = by_series(simple_forecast.forecast_closed_form(line, "drift"))[2]
    assert np.allclose([r[1:] for r in a], [r[1:] for r in b], atol=1e-6)
    wave = special.filter("srl_num = 3")
    a = by_series(arima.forecast_weekly(wave))[3]
    b = by_series(simple_forecast.forecast_closed_form(wave, "snaive"))[3]
    # closed forms hold measures to 1/10000
    assert np.allclose([r[1:] for r in a], [r[1:] for r in b], atol=2e-4)


def test_missing_values_and_dates_are_left_out(spark, weekly_of):
    clean = weekly_of({(1, "a", 1): 10 + noise(30, 60)})
    extra = spark.createDataFrame(
        [(1, None, "a", 9e9, 9e9, 1), (1, dt.date(2000, 1, 2), "a", float("nan"), None, 1)],
        clean.schema,
    )
    a = by_series(arima.forecast_weekly(clean))
    b = by_series(arima.forecast_weekly(clean.union(extra)))
    assert np.allclose([r[1:] for r in a[1]], [r[1:] for r in b[1]])


def test_null_keys_form_a_series(spark, weekly_of):
    df = weekly_of({(1, "a", 1): 10 + noise(31, 60)}).withColumn(
        "category_name", F.lit(None).cast("string")
    )
    assert arima.forecast_weekly(df).count() == HORIZON


def test_difference_orders(weekly, names):
    got = {
        r["srl_num"]: (r["n"], r["d"], r["sd"])
        for r in arima.difference_orders(weekly, season=SEASON).filter("target = 'sales'").collect()
    }
    by_name = {name: got[i] for i, name in names.items()}
    assert by_name["white"] == (150, 0, 0)
    assert by_name["walk"][1] == 1
    assert by_name["wave"][2] == 1
    assert by_name["short"] == (40, 0, 0)


def test_stability_equals_roots():
    rng = np.random.default_rng(3)
    weights = rng.uniform(-1.2, 1.2, (400, 4))
    got = arima._stable(weights)
    biggest = [np.abs(np.roots(np.r_[1, -w])).max() for w in weights]
    for ok, size in zip(got, biggest):
        assert ok == (size < 1 / 1.01)


def test_store_months(spark):
    rows = []
    for month in range(48):
        first = dt.date(2018 + month // 12, 1 + month % 12, 3)
        rows += [(1, first, 100.0 + 2 * month, 1.0), (1, first, 0.5, 1.0), (2, first, 5.0, 2.0)]
    df = spark.createDataFrame(
        rows, "store_number int, date date, sale_dollars double, volume_sold_liters double"
    )
    assert arima.monthly_sales(df).count() == 96
    got = arima.forecast_store_monthly(df).orderBy("store_number", "Date").collect()
    assert len(got) == 24
    first = got[0]
    assert first["Date"] == dt.date(2022, 1, 1)
    assert first["fc_sales"] == pytest.approx(196.5)
    assert first["forecast_volume"] == pytest.approx(2.0)
    assert {r["fc_sales"] for r in got if r["store_number"] == 2} == {5.0}


def test_a_bad_series_does_not_disturb_its_batch():
    y = noise(40, 120)
    rows = np.arange(arima.LAGS, len(y))
    cols = [np.ones(len(rows))] + [y[rows - i] for i in range(arima.LAGS + 1)]
    v = np.column_stack([*cols, np.zeros(len(rows))])
    good = v.T @ v
    batch = np.stack([good, np.full_like(good, np.nan), np.zeros_like(good), np.ones_like(good)])
    count = np.full(4, float(len(rows)))
    no = np.zeros(4, bool)
    best = arima.choose_orders(batch, count, no, ~no, 52)
    alone = arima.choose_orders(batch[:1], count[:1], no[:1], ~no[:1], 52)
    assert best["aicc"][0] == pytest.approx(alone["aicc"][0])
    assert np.isinf(best["aicc"][1]) and np.isfinite(best["weights"]).all()


def test_carried_models_hold_what_a_longer_series_ends_with(spark, weekly_of):
    """Of new weeks the state keeps the differences a fit would keep, on the old scale."""
    rng = np.random.default_rng(11)
    season = 6
    shapes = {
        (1, "a", 1): 40 + rng.normal(size=60),
        (2, None, 2): 100 + np.cumsum(rng.normal(size=60)),
        (3, "a", 3): 10 * np.tile(rng.normal(size=season), 10) + rng.normal(size=60),
        (4, "a", 4): np.full(60, 7.0),
    }
    whole = weekly_of(shapes)
    cut = max(r.date for r in whole.collect())
    before = whole.filter(F.col("date") <= F.date_sub(F.lit(cut), 7 * 9))
    models = arima.fit_models(before, season=season)
    models = spark.createDataFrame(models.collect(), models.schema)
    still = arima.carry(models, before, season=season)
    assert sorted(map(str, still.collect())) == sorted(map(str, models.collect()))
    seen = set()
    for r in arima.carry(models, whole, season=season).where("target = 'sales'").collect():
        y = np.asarray(shapes[r.store_number, r.category_name, r.srl_num])
        x = (y - r.centre) / r.scale if r.scale else y - r.centre
        z = x[season:] - x[:-season] if r.sd else x
        w = np.diff(z, r.d) if r.d else z
        seen.add((r.d, r.sd))
        n = len(r.tail)
        assert r.n == 60 and r.last_date == cut and n == max(season, arima.LAGS) + 1
        for name, own in (("x", x), ("z", z), ("w", w)):
            assert [getattr(t, name) for t in r.tail] == pytest.approx(own[::-1][:n], abs=1e-9)
    assert {sd for _, sd in seen} == {0, 1} and {d for d, _ in seen} >= {0, 1}
