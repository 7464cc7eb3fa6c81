"""Sales lines derived from a star schema of order lines, parts and suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: category ids given to the part types
CATEGORY_IDS = {
    "ECONOMY": 1010000,
    "LARGE": 1020000,
    "MEDIUM": 1030000,
    "PROMO": 1040000,
    "SMALL": 1050000,
    "STANDARD": 1060000,
}


def sales_lines(spark: SparkSession, folder: str, store: str = "supplier") -> DataFrame:
    """One row per order line in the shape of the raw sales file, dates as text.

    The store is the supplier, or with ``store='nation'`` the supplier's nation. Joins
    carry no hint: Spark broadcasts a side only below its size threshold and otherwise
    splits skewed keys at run time. They are left joins, so no line is lost, and a query
    that needs no column of the other side skips the join.
    """

    def read(name):
        return spark.read.parquet(f"{folder}/{name}.parquet")

    lines = read("lineitem").select(
        "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"
    )
    parts = read("part").select("p_partkey", "p_type")
    sales = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    if store == "nation":
        suppliers = read("supplier").select("s_suppkey", "s_nationkey")
        sales = sales.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        number = F.col("s_nationkey")
    elif store == "supplier":
        number = F.col("l_suppkey")
    else:
        raise ValueError(f"store is 'supplier' or 'nation', not {store!r}")
    ids = F.lit(None).cast("int")
    for name, value in CATEGORY_IDS.items():
        ids = F.when(F.col("p_type") == name, value).otherwise(ids)
    return sales.select(
        number.cast("int").alias("store_number"),
        F.date_format("l_shipdate", "MM/dd/yyyy").alias("date"),
        ids.alias("category"),
        F.col("p_type").alias("category_name"),
        F.col("l_extendedprice").alias("sale_dollars"),
        F.col("l_quantity").alias("volume_sold_liters"),
    )
