import datetime as dt

import numpy as np
import pytest

from shelfweek.operators import simple_forecast as sf


def values(forecasts, number):
    rows = forecasts.filter(f"srl_num = {number}").orderBy("Date").collect()
    return np.array([r["fc_sales"] for r in rows])


@pytest.fixture(scope="module")
def weekly(weekly_of):
    rng = np.random.default_rng(5)
    level = np.zeros(200)
    for t in range(1, 200):
        level[t] = 0.8 * level[t - 1] + rng.normal()
    t = np.arange(160)
    return weekly_of(
        {
            (1, "constant", 1): [4.0] * 30,
            (1, "line", 2): 10 + 3.0 * np.arange(30),
            (2, "season", 3): np.round(100 + 50 * np.sin(2 * np.pi * t / 52), 4),
            (3, "ar", 4): np.round(100 + level, 4),
            (4, "one", 5): [9.0],
            (5, "white", 6): np.round(50 + rng.normal(size=100), 4),
            (6, "walk", 7): np.round(500 + np.cumsum(rng.normal(size=150)), 4),
        }
    ).cache()


@pytest.mark.parametrize("model", sf.MODELS)
def test_every_form_continues_a_constant_and_a_single_week(weekly, model):
    got = sf.forecast_closed_form(weekly, model, horizon=4)
    assert values(got, 1) == pytest.approx([4.0] * 4)
    assert values(got, 5) == pytest.approx([9.0] * 4)
    assert got.count() == 7 * 4


def test_forms_against_numpy(weekly):
    rows = weekly.orderBy("srl_num", "date").collect()
    y = np.array([r["total_sales"] for r in rows if r["srl_num"] == 4])
    k = np.arange(1, 61)
    phi, c = np.polyfit(y[:-1], y[1:], 1)
    mu = c / (1 - phi)
    want = {
        "mean": np.full(60, y.mean()),
        "naive": np.full(60, y[-1]),
        "drift": y[-1] + k * (y[-1] - y[0]) / (len(y) - 1),
        "snaive": np.array([y[-52 + (i - 1) % 52] for i in k]),
        "ar1": mu + phi**k * (y[-1] - mu),
    }
    for model, path in want.items():
        got = values(sf.forecast_closed_form(weekly, model, horizon=60), 4)
        assert got == pytest.approx(path, rel=1e-9), model


def test_first_step_and_volume(weekly):
    got = sf.forecast_closed_form(weekly, "naive", horizon=1, first_step="next").collect()
    assert {r["Date"] for r in got} == {dt.date(2022, 9, 4)}
    for r in got:
        assert r["forecast_volume"] == pytest.approx(r["fc_sales"] / 10, abs=1e-4)


def test_unknown_form(weekly):
    with pytest.raises(ValueError, match="unknown model"):
        sf.forecast_closed_form(weekly, "median")


def test_choice_finds_the_form_that_made_the_series(weekly):
    chosen = sf.forecast_choice(weekly).select("srl_num", "sales_model").distinct().collect()
    models = {r["srl_num"]: r["sales_model"] for r in chosen}
    assert models[2] == "drift"
    assert models[3] == "snaive"
    assert models[4] == "ar1"
    assert models[5] == "mean"
    assert models[6] == "mean"


def test_choice_equals_brute_force(weekly):
    chosen = sf.forecast_choice(weekly).select("srl_num", "sales_model").distinct().collect()
    models = {r["srl_num"]: r["sales_model"] for r in chosen}
    series = {}
    for r in weekly.orderBy("date").collect():
        series.setdefault(r["srl_num"], []).append(r["total_sales"])
    for number in (2, 3, 4, 6, 7):
        y = np.array(series[number])
        lag = 52 if len(y) >= 62 else 1
        now, before = y[lag:], y[lag - 1 : -1]
        n = len(now)
        errors = {
            "mean": now - now.mean(),
            "naive": now - before,
            "drift": now - before - (now - before).mean(),
            "ar1": now - np.polyval(np.polyfit(before, now, 1), before),
        }
        if lag == 52:
            errors["snaive"] = y[52:] - y[:-52]
        scores = {}
        for model, e in errors.items():
            k = sf.PARAMETERS[model]
            sse = max((e * e).sum(), 1e-8)
            scores[model] = n * np.log(sse / n) + 2 * k + 2 * k * (k + 1) / (n - k - 1)
        if abs(np.polyfit(before, now, 1)[0]) >= 1:
            scores.pop("ar1")
        assert models[number] == min(scores, key=scores.get), number
