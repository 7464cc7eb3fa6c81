import datetime as dt
from pathlib import Path

import pytest

from shelfweek import schemas
from shelfweek.operators import columns, dashboard
from shelfweek.sinks import files as sinks
from shelfweek.sources import files as sources

# fixed values: the shape of the published forecasts
STORES = [2603, 2633, 2670, 3773, 4829]
CATEGORIES = ["American Vodkas", "Canadian Whiskies", "Straight Bourbon Whiskies"]
FIRST = dt.date(2022, 8, 28)
STEPS = 18


def made_up():
    rows = []
    for store in STORES:
        for category in CATEGORIES:
            for k in range(STEPS):
                day = FIRST + dt.timedelta(7 * k)
                rows.append((store, category, day.isoformat(), 122.47 + k, 1691.14 + store + k))
    return rows


@pytest.fixture(scope="module")
def made_up_csv(tmp_path_factory):
    path = tmp_path_factory.mktemp("made_up") / "forecasts.csv"
    with open(path, "w") as out:
        out.write('"","store_number","category_name","Date","forecast_volume","fc_sales"\n')
        for i, (store, category, day, volume, value) in enumerate(made_up(), 1):
            out.write(f'"{i}",{store},"{category}",{day},{volume},{value}\n')
    return str(path)


@pytest.fixture(scope="module")
def forecasts(spark, made_up_csv):
    return sources.read_forecasts(spark, "csv", made_up_csv)


def test_made_up_forecasts(forecasts):
    assert forecasts.columns == schemas.FORECASTS.fieldNames()
    assert forecasts.schema["Date"].dataType == schemas.FORECASTS["Date"].dataType
    rows = forecasts.collect()
    assert len(rows) == 270
    assert {r["Date"].weekday() for r in rows} == {6}
    assert len({(r["store_number"], r["category_name"]) for r in rows}) == 15
    assert rows[0]["forecast_volume"] == 122.47


def test_dashboard_choices(forecasts):
    got = {tuple(r) for r in dashboard.choices(forecasts).collect()}
    assert got == (
        {("category", c) for c in CATEGORIES}
        | {("store", str(s)) for s in STORES}
        | {("quarter", "2022-Q3"), ("quarter", "2022-Q4")}
        | {("quarter", "Full Forecast"), ("store", "All Stores")}
    )


def test_dashboard_selection(forecasts):
    by_quarter = {
        q: sum(dashboard.selection(forecasts, c, quarter=q).count() for c in CATEGORIES)
        for q in ("2022-Q3", "2022-Q4", "Full Forecast")
    }
    assert by_quarter == {"2022-Q3": 75, "2022-Q4": 195, "Full Forecast": 270}
    one = dashboard.volume_series(forecasts, CATEGORIES[0], store="4829", quarter="2022-Q3")
    assert [r["Date"].day for r in one.collect()] == [28, 4, 11, 18, 25]
    assert one.columns == ["store_number", "Date", "forecast_volume"]
    assert dashboard.sales_series(forecasts, CATEGORIES[1]).count() == 5 * STEPS
    assert dashboard.sales_series(forecasts, "Beer").count() == 0


def test_forecasts_from_parquet_and_table(spark, forecasts, tmp_path):
    path = str(tmp_path / "f")
    sinks.write_dataset(forecasts, path)
    assert sources.read_forecasts(spark, "parquet", path).count() == 270
    sources.register_result(forecasts, "forecast_data")
    assert sources.read_forecasts(spark, "table").count() == 270


def test_unknown_store(spark):
    with pytest.raises(ValueError, match="Unsupported datastore type"):
        sources.read_forecasts(spark, "excel", "x")


def test_paths_from_the_environment(monkeypatch):
    monkeypatch.setenv("DATASET_PATH", "/data")
    monkeypatch.setenv("DATASET_NAME", "all.csv")
    monkeypatch.setenv("DATASET_SMALL_NAME", "small.csv")
    assert sources.dataset_path() == "/data/all.csv"
    assert sources.dataset_path(small=True) == "/data/small.csv"
    monkeypatch.delenv("FORECAST_FILE_LOCATION", raising=False)
    assert sources.forecast_path("d.csv") == "d.csv"
    monkeypatch.setenv("FORECAST_FILE_LOCATION", "f.csv")
    assert sources.forecast_path() == "f.csv"


SALES_TEXT = """Store_Number,Extra,Date,Category,CATEGORY_NAME,Sale_Dollars,Volume_Sold_Liters
4829,a,08/28/2022,1031100,American Vodkas,10.50,1.75
4829,b,8/8/2022,1031100,"Vodkas, Other",1.25,n/a
"""


@pytest.mark.parametrize("infer", [False, True])
def test_sales_by_column_name_in_any_case(spark, tmp_path, infer):
    path = tmp_path / "sales.csv"
    path.write_text(SALES_TEXT)
    got = sources.read_sales(spark, str(path), infer_schema=infer)
    rows = sorted(got.collect(), key=lambda r: r["sale_dollars"])
    assert [r["date"] for r in rows] == ["8/8/2022", "08/28/2022"]
    assert rows[0]["category_name"] == "Vodkas, Other"
    assert rows[1]["sale_dollars"] == 10.5 and rows[1]["store_number"] == 4829
    assert spark.table("sales_data").count() == 2
    assert ("extra" in got.columns) == infer
    if not infer:
        assert rows[0]["volume_sold_liters"] is None


def test_sales_without_header(spark, tmp_path):
    path = tmp_path / "bare.csv"
    path.write_text("1,08/28/2022,7,x,1.0,2.0\n")
    got = sources.read_csv(spark, str(path), schemas.SALES_RAW, header=False)
    assert got.first()["volume_sold_liters"] == 2.0


def test_weekly_round_trip(spark, weekly_of, tmp_path):
    weekly = weekly_of({(1, "a", 1): [1.0, 2.5]}).select(*schemas.WEEKLY.fieldNames())
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        sinks.write_dataset(weekly, path, fmt)
        sinks.write_dataset(weekly, path, fmt)
        got = sources.read_weekly(spark, path, fmt)
        assert sorted(got.collect()) == sorted(weekly.collect())
        assert got.schema.simpleString() == schemas.WEEKLY.simpleString()
    cached = sources.read_weekly(spark, str(tmp_path / "csv"), "csv", memory=True)
    assert cached.is_cached
    cached.unpersist()


def test_published_shape_is_written(spark, forecasts, tmp_path):
    numbered = forecasts.selectExpr("*", "7 AS srl_num")
    path = tmp_path / "out"
    sinks.write_forecasts(numbered, str(path), "csv")
    head = next(path.glob("part-*.csv")).read_text().splitlines()[0]
    assert head == "store_number,category_name,Date,forecast_volume,fc_sales"
    assert sources.read_forecasts(spark, "csv", str(path)).count() == 270


def test_settle_writes_where_the_session_says(spark):
    df = spark.range(5)
    folder = spark.conf.get("spark.checkpoint.dir")
    got = sinks.settle(df)
    assert got.inputFiles()[0].startswith(f"file://{folder}/step-")
    assert got.count() == 5 and got.dtypes == df.dtypes
    sinks.forget(got)
    assert not list(Path(folder).glob(got.inputFiles()[0].split("/")[-2]))


class Session:
    """Stands in for a session of which only the settings are asked."""

    def __init__(self, **conf):
        conf = {"spark__master": "yarn", **conf}
        self.conf = {key.replace("__", "."): value for key, value in conf.items()}


def test_one_shared_folder_whatever_the_master():
    unset = Session(spark__sql__warehouse__dir="hdfs://x/wh")
    assert sinks.scratch_folder(unset) == "hdfs://x/wh/_steps"
    named = Session(spark__checkpoint__dir="s3://y/z/", spark__sql__warehouse__dir="w")
    assert sinks.scratch_folder(named) == "s3://y/z"
    alone = {"spark__sql__warehouse__dir": "file:/tmp/wh"}
    assert sinks.scratch_folder(Session(**alone, spark__master="local[4]")) == "file:/tmp/wh/_steps"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sinks.scratch_folder(Session(**alone, spark__master="yarn"))


BAD_TEXT = """store_number,date,category,category_name,sale_dollars,volume_sold_liters
A12,08/28/2022,7,x,$12.50,1.5
12,02/30/2022,7,x,"1,234.5",2
13,,,x,1e400,nan
14,08/28/2022,9999999999,,1.25,
"""


def test_unreadable_values_are_counted_or_fail(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(BAD_TEXT)
    texts = sources.read_texts(spark, str(path), schemas.SALES_RAW)
    got = {r[0]: tuple(r)[1:] for r in columns.value_audit(texts, schemas.SALES_RAW).collect()}
    assert got == {
        "store_number": (4, 0, 1),
        "date": (4, 1, 1),
        "category": (4, 1, 1),
        "category_name": (4, 1, 0),
        "sale_dollars": (4, 0, 3),
        # not a number is a double, and counts as missing in sums
        "volume_sold_liters": (4, 1, 1),
    }
    read = sources.read_sales(spark, str(path))
    assert sorted((r.store_number or 0, r.sale_dollars) for r in read.collect()) == [
        (0, None),
        (12, None),
        (13, None),
        (14, 1.25),
    ]
    with pytest.raises(Exception, match="unreadable store_number: A12"):
        sources.read_sales(spark, str(path), fail_on_bad=True).select("store_number").collect()


HEADER = ["store_number", "date", "category", "category_name", "sale_dollars", "volume_sold_liters"]


def write_csv(path, header, rows):
    path.write_text("\n".join([",".join(header), *[",".join(r) for r in rows]]) + "\n")


def test_every_file_of_a_folder_is_read_by_its_own_header(spark, tmp_path):
    folder = tmp_path / "sales folder"
    folder.mkdir()
    line = ["11", "08/28/2022", "7", "x", "1.5", "2.5"]
    write_csv(folder / "a.csv", HEADER, [line])
    write_csv(folder / "b.csv", HEADER[::-1], [["3.5", "4.5", "y", "8", "08/29/2022", "12"]])
    # two columns of numbers swapped, one more column, names in other case
    swapped = ["Extra", "STORE_NUMBER", "Date", "category", "category_name", "volume_sold_liters", "sale_dollars"]
    write_csv(folder / "c.csv", swapped, [["e", "13", "08/30/2022", "9", "z", "5.5", "6.5"]])
    (folder / "empty.csv").write_text("")
    (folder / "d.csv").write_text("﻿" + ",".join(HEADER) + "\n14,08/31/2022,1,w,7.5,8.5\n")
    got = {r.store_number: tuple(r)[1:] for r in sources.read_sales(spark, str(folder)).collect()}
    assert got == {
        11: ("08/28/2022", 7, "x", 1.5, 2.5),
        12: ("08/29/2022", 8, "y", 4.5, 3.5),
        13: ("08/30/2022", 9, "z", 6.5, 5.5),
        14: ("08/31/2022", 1, "w", 7.5, 8.5),
    }


def test_a_file_without_a_column_or_with_two_is_named(spark, tmp_path):
    write_csv(tmp_path / "a.csv", HEADER, [["1"] * 6])
    write_csv(tmp_path / "b.csv", HEADER[:-1], [["1"] * 5])
    with pytest.raises(ValueError, match="b.csv: no column volume_sold_liters"):
        sources.read_sales(spark, str(tmp_path))
    write_csv(tmp_path / "b.csv", [*HEADER, "DATE"], [["1"] * 7])
    with pytest.raises(ValueError, match="b.csv: several columns date"):
        sources.read_sales(spark, str(tmp_path))


def test_packed_files_and_empty_ones(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write(",".join(HEADER[::-1]) + "\n1.0,2.0,x,7,08/28/2022,5\n")
    assert sources.read_sales(spark, str(tmp_path)).first().store_number == 5
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.csv").write_text("\n")
    empty = sources.read_sales(spark, str(tmp_path / "none"))
    assert empty.columns == HEADER and empty.collect() == []
    assert sources.broken_lines(spark, str(tmp_path / "none"), schemas.SALES_RAW).collect() == []


BROKEN_TEXT = """store_number,date,category,category_name,sale_dollars,volume_sold_liters
11,08/28/2022,7,x,1.5,2.5
12,08/28/2022
13,08/28/2022,7,x,1.5,2.5,9
14,08/28/2099,7,"x, y
15,08/28/2022,7,"x, y",1.5,n/a
"""


def test_broken_lines_are_kept_aside_counted_or_fail(spark, tmp_path):
    path = tmp_path / "sales"
    path.mkdir()
    (path / "broken.csv").write_text(BROKEN_TEXT)
    write_csv(path / "good.csv", HEADER[::-1], [["3.5", "4.5", "y", "8", "08/29/2022", "16"]])
    read = sources.read_sales(spark, str(path))
    assert sorted(r.store_number for r in read.collect()) == [11, 15, 16]
    # however few columns are asked for
    assert read.select("category").count() == 3 == read.count()
    aside = sources.broken_lines(spark, str(path), schemas.SALES_RAW).collect()
    assert {r.file.rsplit("/")[-1] for r in aside} == {"broken.csv"}
    assert sorted(r.line for r in aside) == ["12,08/28/2022", "13,08/28/2022,7,x,1.5,2.5,9", '14,08/28/2099,7,"x, y']
    texts = sources.read_texts(spark, str(path), schemas.SALES_RAW)
    audit = columns.value_audit(texts, schemas.SALES_RAW, broken=sources.BROKEN)
    got = {r[0]: tuple(r)[1:] for r in audit.collect()}
    assert got["(line)"] == (6, 0, 3) and got["store_number"] == (3, 0, 0)
    assert got["volume_sold_liters"] == (3, 0, 1)
    assert texts.filter(f"{sources.BROKEN} IS NOT NULL").count() == 3
    with pytest.raises(Exception, match="broken line: 1"):
        sources.read_sales(spark, str(path), fail_on_bad=True).collect()
    with pytest.raises(Exception, match="broken line: 1"):
        sources.read_csv(spark, str(path), schemas.SALES_RAW).collect()
