import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfweek.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions=4,
        spark__driver__memory="4g",
        # plan texts are checked in full
        spark__sql__maxMetadataStringLength=100000,
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def day():
    return dt.date.fromisoformat


@pytest.fixture(scope="session")
def weekly_of(spark):
    """A weekly relation from {(store, category, number): [sales, ...]}, volume = sales / 10,
    all series ending in the same week."""

    def make(series, end=dt.date(2022, 8, 28)):
        rows = []
        for (store, category, number), values in series.items():
            for back, v in enumerate(reversed(list(values))):
                rows.append(
                    (store, end - dt.timedelta(7 * back), category, float(v), float(v) / 10, number)
                )
        return spark.createDataFrame(
            rows,
            "store_number int, date date, category_name string, total_sales double, "
            "total_volume_sold double, srl_num int",
        )

    return make
