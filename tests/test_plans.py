"""What the plans look like, since that is what holds at scale."""

import re

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from shelfweek.operators import (
    arima,
    dashboard,
    filters,
    ranking,
    rollups,
    seasonal_arima,
    series,
    simple_forecast,
)
from shelfweek.plans import stages
from shelfweek.schemas import SERIES_KEYS
from shelfweek.sinks import files as sinks
from shelfweek.sources import files as sources
from shelfweek.sinks.files import write_sales_small
from shelfweek.sources.star_schema import sales_lines

TABLES = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hashed(text):
    """Exchanges by key, the shuffles that move rows."""
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


@pytest.fixture(scope="module")
def sales(spark):
    return sales_lines(spark, TABLES)


@pytest.fixture(scope="module")
def weekly(sales):
    # what follows is planned over the stored relation, as the jobs read it
    return sinks.settle(stages.weekly_relation(sales))


PYTHON = {
    "forecast_weekly",
    "forecast_top_slice",
    "forecast_top_series",
    "forecast_store_monthly",
    "forecast_seasonal",
    "seasonal_model_table",
    "holdout_errors",
    "holdout_errors_seasonal",
    "model_table",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_python_only_where_stated(spark, name):
    text = plan(QUERIES[name](spark, TABLES))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    steps = re.findall(r"(ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|BatchEvalPython)", text)
    assert bool(steps) == (name in PYTHON)
    assert "BatchEvalPython" not in steps


def test_weekly_sums_shuffle_partial_sums_once(sales):
    text = plan(rollups.weekly_sales(sales))
    assert "partial_try_sum" in text and len(hashed(text)) == 1
    # only the columns in use are read
    assert "l_discount" not in text and "l_tax" not in text
    # the date of a line is parsed in one place
    assert text.count("Filter isnotnull(next_day") == 0


def test_sales_lines_are_read_once(spark, sales, tmp_path, monkeypatch):
    """What was planned, writes included: only the weekly sums read the lines."""
    written = []
    own = sinks.settle

    def settle(df):
        written.append(plan(df))
        return own(df)

    for module in (stages, series, ranking):
        monkeypatch.setattr(module, "settle", settle)
    sliced = ranking.top_slice(stages.weekly_relation(sales))
    assert sum("l_shipdate" in text for text in [*written, plan(sliced)]) == 1
    first = written[0]
    assert "l_shipdate" in first and "partial_try_sum" in first
    assert "CartesianProduct" not in first and "NestedLoop" not in first
    # the last week is the newest of the settled sums, from its date column
    assert "ReadSchema: struct<date:date>" in plan(stages.active_weekly(sales))


def test_dashboard_filters_reach_the_stored_forecast(spark, weekly, tmp_path):
    stored = sinks.settle(simple_forecast.forecast_closed_form(weekly, "naive"))
    text = plan(dashboard.selection(stored, "PROMO", 3, "2001-Q4"))
    assert "GreaterThanOrEqual(Date,2001-10-01)" in text and "LessThanOrEqual(Date,2001-12-31)" in text
    assert "EqualTo(category_name,PROMO)" in text and "EqualTo(store_number,3)" in text


def test_cutoff_reads_one_column(sales):
    text = plan(stages.recent_sales(sales))
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in text and not hashed(text)


def test_filters_on_the_stored_window_reach_the_scan(spark, sales, tmp_path):
    path = str(tmp_path / "small")
    write_sales_small(stages.recent_sales(sales), path)
    small = spark.read.parquet(path)
    kept = filters.category_window(
        small, "PROMO", "2000-01-01", "2000-03-31", year=2000, date="date_parsed"
    )
    text = plan(kept.select("store_number", "sale_dollars"))
    assert "PartitionFilters: [isnotnull(year" in text
    assert "GreaterThanOrEqual(date_parsed" in text and "EqualTo(category_name,PROMO)" in text
    newest = filters.at_last_date(small, "date_parsed").select("sale_dollars")
    assert "volume_sold_liters" not in plan(newest)


def test_numbering_sums_only_blocks_in_one_place(weekly):
    text = plan(series.number_series(weekly.drop("srl_num")))
    assert len(re.findall(r"Exchange SinglePartition", text)) == 1
    assert re.search(r"Exchange hashpartitioning\(_block", text)


def test_top_n_is_not_a_full_sort_and_the_slice_is_worked_out_once(weekly, monkeypatch):
    written = []
    own = sinks.settle

    def settle(df):
        written.append(plan(df))
        return own(df)

    monkeypatch.setattr(ranking, "settle", settle)
    text = plan(ranking.top_slice(weekly))
    (first,) = written
    assert first.count("TakeOrderedAndProject") == text.count("TakeOrderedAndProject") == 1
    assert "rangepartitioning" not in first + text
    # the categories are looked for when the slice is settled, not again
    assert "total_yearly_sales" in first and "Aggregate(keys=[category_name" not in text


@pytest.fixture(scope="module")
def bucketed(spark, weekly, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bucketed") / "weekly")
    sinks.write_weekly_table(weekly, "bucketed_weekly", 3, path)
    yield spark.table("bucketed_weekly"), path
    spark.sql("DROP TABLE bucketed_weekly")


def test_no_shuffle_over_the_bucketed_table(spark, bucketed, weekly):
    table, path = bucketed
    last = sources.stored_limits(spark, path).first()["last"]
    active = series.active_series(table, F.lit(last))
    placed = series.positions(table, SERIES_KEYS)
    fitted = arima.fit_models(table)
    seasonal = seasonal_arima.fit_models(table)
    for df in (active, placed, fitted, seasonal):
        assert "Exchange" not in plan(df)
    assert sorted(active.select(*weekly.columns).collect(), key=str) == sorted(
        series.active_series(weekly).collect(), key=str
    )
    key = lambda r: (r.srl_num, r.target)
    for a, b in zip(sorted(fitted.collect(), key=key), sorted(arima.fit_models(weekly).collect(), key=key)):
        assert (a.d, a.sd, a.fit.p, a.fit.q) == (b.d, b.sd, b.fit.p, b.fit.q)
        assert a.weights == pytest.approx(b.weights, abs=1e-6)


def test_limits_come_from_the_footers(spark, bucketed, weekly):
    found = sources.stored_limits(spark, bucketed[1])
    assert "PushedAggregation: [MIN(date), MAX(date), COUNT(*)]" in found._jdf.queryExecution().explainString(
        found.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    want = weekly.agg(F.min("date"), F.max("date"), F.count("*")).first()
    assert tuple(found.first()) == tuple(want)
    # other reads go on as before
    assert "BatchScan" not in plan(spark.read.parquet(bucketed[1]))


def test_merged_bitmaps_read_no_rows_again(spark, weekly):
    bits = sinks.settle(rollups.distinct_bitmaps(weekly, ["srl_num"], F.year("date")))
    text = plan(rollups.merged_counts(bits, {"srl_num": "n"}))
    assert "total_sales" not in text and text.count("FileScan") == 1


@pytest.mark.parametrize("partitions", [None, 6])
def test_forecast_shuffles_rows_once(weekly, partitions):
    text = plan(arima.forecast_weekly(weekly, partitions=partitions))
    assert text.count("ArrowEvalPython") == 1
    # rows by series below the fit, one row per series and target above it
    above, below = text.split("ArrowEvalPython")
    assert len(hashed(above)) == 1 and len(hashed(below)) == 1
    assert ("REPARTITION_BY_NUM" in below) == bool(partitions)


def test_closed_forms_compute_only_what_they_use(weekly):
    mean = plan(simple_forecast.forecast_closed_form(weekly, "mean"))
    assert "collect_list" not in mean and "lead(" not in mean
    assert "collect_list" in plan(simple_forecast.forecast_closed_form(weekly, "snaive"))


def test_closed_forms_shuffle_once(weekly):
    assert len(hashed(plan(simple_forecast.forecast_choice(weekly)))) == 1


def test_grouped_function_gets_the_stated_partitions(weekly):
    out = series.apply_per_series(
        weekly, series.PAIR, lambda pdf: pdf[["total_sales"]].head(1), "v double", partitions=6
    )
    exchanges = re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\), (\w+)", plan(out))
    assert exchanges == [("6", "REPARTITION_BY_NUM")]
