"""What operators share between their steps: ``settle`` writes an intermediate table to the
folder all executors share, ``sent`` hands an object of bounded size to all tasks."""

from __future__ import annotations

import pickle
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfweek.sinks.files import scratch_path, settle

__all__ = ["numbered", "sent", "settle"]


def numbered(df: DataFrame, name: str = "_row") -> DataFrame:
    """``df`` with a number for every row, settled: two reads of a table may be cut into
    partitions differently, and numbers given anew would then fall on other rows. Whole texts
    are written, so they are packed well."""
    numbers = df.withColumn(name, F.monotonically_increasing_id())
    path = scratch_path(df.sparkSession)
    numbers.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(numbers.schema).parquet(path)


def sent(spark: SparkSession, thing) -> Callable:
    """Send an object of bounded size to all executors once; tasks call the result to get
    it. Its class travels with it, as the functions of this package do."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(thing))
    return lambda: pickle.loads(packed.value)
