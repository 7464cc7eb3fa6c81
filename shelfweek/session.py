"""Session settings the jobs rely on. A cluster session made elsewhere works too."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "shelfweek", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution, UTC dates and the web page off.

    Sizes (memory, executors, shuffle partitions) belong to the submit command;
    pass them as ``conf`` with dots written as double underscores only in tests.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # the forecast plan holds more generated classes than the default cache keeps
        .config("spark.sql.codegen.cache.maxEntries", "1000")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def task_slots(df) -> int:
    """Partition count for jobs that name one: the session's shuffle setting."""
    spark = df.sparkSession
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
