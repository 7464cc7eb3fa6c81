import datetime as dt

import pytest

from shelfweek import jobs
from shelfweek.operators import columns
from shelfweek.plans import stages
from shelfweek.sinks.files import write_dataset
from shelfweek.sources import files as sources
from shelfweek.sources.star_schema import sales_lines

TABLES = "/root/testdata/sf0.001"


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_every_pair_of_stages_in_either_format(spark, tmp_path, monkeypatch, fmt):
    # paths by the environment, with names that say nothing about the format
    monkeypatch.setenv("DATASET_PATH", str(tmp_path))
    monkeypatch.setenv("DATASET_NAME", "raw.csv")
    monkeypatch.setenv("DATASET_SMALL_NAME", "small.csv")
    monkeypatch.setenv("FORECAST_FILE_LOCATION", str(tmp_path / "forecasts.csv"))
    weekly, models, picked = (str(tmp_path / n) for n in ("weekly", "models", "picked"))
    write_dataset(sales_lines(spark, TABLES, "nation"), str(tmp_path / "raw.csv"), "csv")
    jobs.main(["ingest", "--years", "5", "--target-format", fmt])
    jobs.main(["prepare", "--target", weekly, "--source-format", fmt, "--target-format", fmt])
    jobs.main(
        ["forecast", "--source", weekly, "--source-format", fmt, "--target-format", fmt]
        + ["--models", models, "--categories", "3", "--stores", "5"]
    )
    series = sources.read_weekly(spark, weekly, fmt)
    ends = series.groupBy("srl_num").agg({"date": "max"}).toDF("n", "last").collect()
    assert {r["last"] for r in ends} == {dt.date(2001, 11, 4)}
    forecasts = sources.read_forecasts(spark, fmt)
    count = forecasts.select("store_number", "category_name").distinct().count()
    assert count > 0 and forecasts.count() == 18 * count
    assert forecasts.filter("forecast_volume IS NULL OR fc_sales IS NULL").count() == 0
    assert spark.read.parquet(models).count() == 2 * count
    category = forecasts.first()["category_name"]
    jobs.main(
        ["select", "--target", picked, "--category", category, "--quarter", "2001-Q4"]
        + ["--source-format", fmt, "--target-format", fmt]
    )
    rows = sources.read_forecasts(spark, fmt, picked)
    assert 0 < rows.count() == forecasts.filter(
        (forecasts.category_name == category) & (forecasts.Date <= dt.date(2001, 12, 31))
    ).count()


def test_weekly_is_the_same_from_text_and_from_the_small_dataset(spark, tmp_path):
    raw, small = str(tmp_path / "raw.csv"), str(tmp_path / "small")
    write_dataset(sales_lines(spark, TABLES), raw, "csv")
    jobs.ingest(spark, raw, small, years=100)
    jobs.prepare(spark, raw, str(tmp_path / "a"), source_format="csv")
    jobs.prepare(spark, small, str(tmp_path / "b"))
    a, b = (sorted(spark.read.parquet(str(tmp_path / n)).collect()) for n in "ab")
    assert a == b and a


def test_profile_and_monthly(spark, tmp_path):
    raw = str(tmp_path / "raw.csv")
    write_dataset(sales_lines(spark, TABLES, "nation"), raw, "csv")
    jobs.main(["profile", "--source", raw, "--target", str(tmp_path / "profile")])
    read = {n: spark.read.parquet(str(tmp_path / "profile" / n)) for n in ("years", "category_years", "counts", "unreadable")}
    assert read["years"].agg({"row_count": "sum"}).first()[0] == read["counts"].first()["row_count"]
    assert read["category_years"].count() > 0
    assert read["unreadable"].agg({"unreadable": "sum"}).first()[0] == 0
    jobs.main(
        ["monthly", "--source", raw, "--source-format", "csv", "--target", str(tmp_path / "m")]
        + ["--category", "PROMO", "--start", "1995-01-01", "--end", "2001-12-31"]
    )
    rows = spark.read.option("header", True).csv(str(tmp_path / "m"))
    assert rows.count() == 12 * rows.select("store_number").distinct().count() > 0


def test_selection_of_series(weekly_of):
    weekly = weekly_of({(i, "a", i): [i, 2 * i] for i in range(1, 5)})
    assert jobs.select_series(weekly, None, None, None).count() == 8
    assert jobs.select_series(weekly, None, None, 2).count() == 4
    assert jobs.select_series(weekly, 1, 3, None).count() == 6
    for clash in ((1, None, None), (None, 3, None), (1, 3, 2)):
        with pytest.raises(ValueError):
            jobs.select_series(weekly, *clash)
    with pytest.raises(ValueError, match="horizon"):
        jobs.forecast(None, "x", "y", horizon=0)


def test_counts_are_taken_while_the_jobs_run(spark, tmp_path, capsys):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text(
        "store_number,date,category,category_name,sale_dollars,volume_sold_liters\n"
        "1,08/28/2022,7,x,1.5,2.5\n2,08/30/2022,7,x,$3,2.5\n3,,7,x,1.5,2.5\n"
        "4,02/30/2022,7,x,1.5,2.5\n5,08/28/2010,7,x,1.5,2.5\n6,08/28/2099\n"
    )
    (raw / "b.csv").write_text(
        "volume_sold_liters,sale_dollars,category_name,category,date,store_number\n2,1,x,7,08/29/2022,9\n"
    )
    small, weekly, aside = (str(tmp_path / n) for n in ("small", "weekly", "aside"))
    jobs.main(["ingest", "--source", str(raw), "--target", small, "--broken", aside, "--report", str(tmp_path / "r")])
    want = {
        "lines": 7,
        "broken": 1,
        "undated": 1,
        "unreadable_date": 1,
        "unreadable_store_number": 0,
        "unreadable_category": 0,
        "unreadable_sale_dollars": 1,
        "unreadable_volume_sold_liters": 0,
        "written": 3,
    }
    import json

    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == want
    assert spark.read.parquet(str(tmp_path / "r")).first().asDict() == want | {"stage": "ingest"}
    assert [r.line for r in spark.read.parquet(aside).collect()] == ["6,08/28/2099"]
    assert spark.read.parquet(small).count() == 3
    assert jobs.prepare(spark, small, weekly) == {"lines": 3, "undated": 0}
    text = tmp_path / "text.csv"
    text.write_text("store_number,date,category,category_name,sale_dollars,volume_sold_liters\n1,x,7,x,1,1\n2,08/28/2022,7,x,1,1\n")
    assert jobs.prepare(spark, str(text), weekly, source_format="csv") == {"lines": 2, "undated": 1}
    none = jobs.ingest(spark, str(text), small, broken=str(tmp_path / "none"))
    assert none["broken"] == 0 and not (tmp_path / "none").exists()


def test_refreshed_sums_equal_a_rebuild_and_touch_only_the_weeks_of_new_lines(spark, tmp_path):
    header = "store_number,date,category,category_name,sale_dollars,volume_sold_liters\n"
    lines = [
        f"{k % 4},{1 + k % 12}/{1 + k % 28}/2021,7,{'x' if k % 3 else ''},{k}.25,{k / 8}" for k in range(200)
    ]
    late = ["1,01/05/2021,7,x,1000.5,3", "9,12/30/2021,7,y,2,3", "2,13/40/2021,7,x,5,5"]
    for name, rows in (("old", lines), ("new", late), ("all", lines + late)):
        (tmp_path / f"{name}.csv").write_text(header + "\n".join(rows) + "\n")
        jobs.ingest(spark, str(tmp_path / f"{name}.csv"), str(tmp_path / name), years=9)
    sums, whole = tmp_path / "sums", tmp_path / "whole"
    jobs.main(["sums", "--source", str(tmp_path / "old"), "--target", str(sums)])

    def files():
        return {p: p.stat().st_mtime_ns for p in sums.glob("date=*/part-*")}

    before = files()
    refresh = ["refresh", "--source", str(tmp_path / "all"), "--new", str(tmp_path / "new"), "--target", str(sums)]
    jobs.main(refresh)
    after = files()
    touched = {"date=2021-01-03", "date=2021-12-26"}
    assert {p.parent.name for p in before.keys() ^ after.keys()} == touched
    jobs.main(["sums", "--source", str(tmp_path / "all"), "--target", str(whole)])
    read = lambda p: sorted(map(str, sources.read_weekly_sums(spark, str(p)).collect()))
    assert read(sums) == read(whole)
    jobs.main(refresh)
    assert read(sums) == read(whole)
    # nothing new, nothing written
    same = files()
    (tmp_path / "none.csv").write_text(header + "1,x,7,x,1,1\n")
    none = columns.replace_text_date(sources.read_sales(spark, str(tmp_path / "none.csv")))
    assert stages.refresh_weekly_sums(none, none, str(sums), parsed=True) == []
    assert files() == same
    jobs.main(["prepare", "--from-sums", "--source", str(sums), "--target", str(tmp_path / "a")])
    jobs.main(["prepare", "--source", str(tmp_path / "all"), "--target", str(tmp_path / "b")])
    a, b = (sorted(map(str, spark.read.parquet(str(tmp_path / n)).collect())) for n in "ab")
    assert a == b and a


@pytest.mark.parametrize("method", ["additive", "seasonal"])
def test_stored_models_are_projected_without_a_fit(spark, weekly_of, tmp_path, monkeypatch, method):
    import numpy as np

    rng = np.random.default_rng(3)
    whole = {(k, "a", k): 50 + np.cumsum(rng.normal(size=80)) for k in range(1, 4)}
    end = dt.date(2022, 8, 28)
    weekly_of(whole).write.parquet(str(tmp_path / "later"))
    cut = {k: v[:-6] for k, v in whole.items()}
    weekly_of(cut, end - dt.timedelta(42)).write.parquet(str(tmp_path / "weekly"))
    paths = {n: str(tmp_path / n) for n in ("weekly", "later", "first", "again", "moved", "state", "carried")}
    jobs.main(["forecast", "--source", paths["weekly"], "--target", paths["first"], "--method", method, "--state", paths["state"]])
    monkeypatch.setattr(jobs.METHODS[method], "fit_models", None)
    common = ["project", "--state", paths["state"], "--method", method]
    jobs.main([*common, "--source", paths["weekly"], "--target", paths["again"]])
    first, again = (
        sorted(map(tuple, sources.read_forecasts(spark, "csv", paths[n]).collect())) for n in ("first", "again")
    )
    assert first == again and len(first) == 54
    jobs.main([*common, "--source", paths["later"], "--target", paths["moved"], "--carried", paths["carried"]])
    moved = sorted(map(tuple, sources.read_forecasts(spark, "csv", paths["moved"]).collect()))
    assert {r[2] for r in moved} == {end + dt.timedelta(7 * k) for k in range(18)} and moved != first
    # what was carried is a state again
    jobs.main(["project", "--state", paths["carried"], "--method", method, "--source", paths["later"], "--target", paths["again"]])
    assert sorted(map(tuple, sources.read_forecasts(spark, "csv", paths["again"]).collect())) == moved
