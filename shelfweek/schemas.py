"""Declared schemas. Reading with them spares the inference pass over the file."""

from pyspark.sql import types as T

SALES_RAW = T.StructType(
    [
        T.StructField("store_number", T.IntegerType()),
        T.StructField("date", T.StringType()),
        T.StructField("category", T.IntegerType()),
        T.StructField("category_name", T.StringType()),
        T.StructField("sale_dollars", T.DoubleType()),
        T.StructField("volume_sold_liters", T.DoubleType()),
    ]
)

# the trailing window as stored: raw lines with their parsed date and calendar parts
SALES_SMALL = T.StructType(
    SALES_RAW.fields
    + [T.StructField("date_parsed", T.DateType())]
    + [
        T.StructField(name, T.IntegerType())
        for name in ("year", "month", "day_of_month", "week_number", "day_of_week", "quarter")
    ]
    + [T.StructField("is_weekend", T.BooleanType())]
)

WEEKLY = T.StructType(
    [
        T.StructField("store_number", T.IntegerType()),
        T.StructField("date", T.DateType()),
        T.StructField("category_name", T.StringType()),
        T.StructField("total_sales", T.DoubleType()),
        T.StructField("total_volume_sold", T.DoubleType()),
        T.StructField("srl_num", T.IntegerType()),
    ]
)

# weekly sums of all series, before they are numbered; stored in a folder per week
WEEKLY_SUMS = T.StructType([f for f in WEEKLY if f.name != "srl_num"])

FORECASTS = T.StructType(
    [
        T.StructField("store_number", T.IntegerType()),
        T.StructField("category_name", T.StringType()),
        T.StructField("Date", T.DateType()),
        T.StructField("forecast_volume", T.DoubleType()),
        T.StructField("fc_sales", T.DoubleType()),
    ]
)

# keys of one weekly series, and the measures forecast for it
SERIES_KEYS = ["store_number", "category_name", "srl_num"]
TARGETS = {"sales": "total_sales", "volume": "total_volume_sold"}
