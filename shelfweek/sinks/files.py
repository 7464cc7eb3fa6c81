"""Writing results, and setting a shared intermediate result down between steps."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def write_dataset(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None
) -> None:
    """Overwrite a dataset. CSV gets a header and no row numbers."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_sales_small(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The trailing window, in folders by year so that later filters skip whole years."""
    write_dataset(df, path, fmt, partition_by=["year"] if fmt == "parquet" else None)


def write_forecasts(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Forecasts in their published shape, without the series number."""
    write_dataset(df.drop("srl_num"), path, fmt)


def write_models(models: DataFrame, path: str) -> None:
    """Fitted models, or their orders and coefficients, as Parquet."""
    write_dataset(models, path)


def _by_week(sums: DataFrame):
    # rows of a week meet, a large week in several files
    return sums.hint("rebalance", "date").write.mode("overwrite").partitionBy("date")


def write_weekly_sums(sums: DataFrame, path: str) -> None:
    """Weekly sums in a folder per week."""
    _by_week(sums).option("partitionOverwriteMode", "static").parquet(path)


def replace_weeks(sums: DataFrame, path: str) -> None:
    """The weeks of ``sums`` in the place of what is stored of them; no other is touched."""
    _by_week(sums).option("partitionOverwriteMode", "dynamic").parquet(path)


def write_weekly_table(weekly: DataFrame, name: str, buckets: int, path: str | None = None) -> None:
    """The weekly relation as a table of the catalog, bucketed by series and sorted: what
    works by series needs no shuffle."""
    pair = ["store_number", "category_name"]
    writer = weekly.repartition(buckets, *pair).write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, *pair).sortBy(*pair, "date").saveAsTable(name)


def scratch_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or where that is unset a
    folder in the warehouse. On a cluster a warehouse on a local disk is an error: executors
    would not see one another's files."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        local = warehouse.startswith("file:") or "://" not in warehouse
        if local and not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"{warehouse}/_steps"
    return folder.rstrip("/")


def scratch_path(spark: SparkSession) -> str:
    """A new place in the shared folder; what is written there goes when the driver ends."""
    path = f"{scratch_folder(spark)}/step-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(place)
    return path


def settle(df: DataFrame) -> DataFrame:
    """Write a result that several later steps read to the shared folder, and go on from the
    written table: computed once, and kept when executors are lost. The table goes when the
    driver ends; ``forget`` removes it earlier."""
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove the tables ``settle`` wrote that ``df`` reads directly; it cannot be read then."""
    spark = df.sparkSession
    for file in df.inputFiles():
        place = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if place.getName().startswith("step-"):
            fs = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
            fs.delete(place, True)
