"""Sales, weekly and forecast relations from files and tables."""

from __future__ import annotations

import csv
import os
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfweek import schemas
from shelfweek.operators.columns import lower_names, readable_value


def dataset_path(small: bool = False) -> str:
    """``DATASET_PATH`` joined with ``DATASET_NAME`` or ``DATASET_SMALL_NAME``."""
    name = "DATASET_SMALL_NAME" if small else "DATASET_NAME"
    return os.path.join(os.environ.get("DATASET_PATH", ""), os.environ.get(name, ""))


def forecast_path(default: str = "forecast_results.csv") -> str:
    return os.environ.get("FORECAST_FILE_LOCATION", default)


#: Column of the lines that do not have as many fields as their file's header.
BROKEN = "_broken_line"
HEADERS_AT_ONCE = 16


def _first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file that holds something, unpacked if the name says so."""
    jvm = spark._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    if codec:
        stream = codec.createInputStream(stream)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
        return line
    finally:
        reader.close()


def csv_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The column names of every CSV file of a path, by file. Only first lines are read."""
    files = [unquote(f) for f in spark.read.text(path).inputFiles()]
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        firsts = pool.map(lambda f: _first_line(spark, f), files)
    return {
        file: [name.strip() for name in next(csv.reader([line.removeprefix("\ufeff")]))]
        for file, line in zip(files, firsts)
        if line is not None
    }


def _layouts(headers: dict[str, list[str]], wanted: list[str]) -> dict[tuple, list[str]]:
    """Files with the wanted columns in the same places, by the names given to their fields."""
    found: dict[tuple, list[str]] = {}
    by_lower = {name.lower(): name for name in wanted}
    for file, header in headers.items():
        names = [name.lower() for name in header]
        for name in by_lower:
            if names.count(name) != 1:
                problem = "no column" if name not in names else "several columns"
                raise ValueError(f"{file}: {problem} {name}")
        own = tuple(by_lower.get(name, f"_c{k}") for k, name in enumerate(names))
        found.setdefault(own, []).append(file)
    return found


def _texts(spark: SparkSession, path: str, schema: T.StructType, extra: list) -> DataFrame:
    """The columns of a schema as text and the line where it is broken; ``extra`` columns may
    use the file's metadata."""
    layouts = _layouts(csv_headers(spark, path), schema.fieldNames())
    frames = []
    for names, files in layouts.items():
        own = T.StructType([T.StructField(n, T.StringType()) for n in (*names, BROKEN)])
        reader = spark.read.option("header", True).option("columnNameOfCorruptRecord", BROKEN)
        # a line is known to be broken only if all its fields are parsed
        rows = reader.option("columnPruning", False).schema(own).csv(files)
        # Spark reads no broken lines alone: the empty end of another column goes with them
        line = F.concat(BROKEN, F.substring(F.coalesce(schema[0].name, F.lit("")), 1, 0))
        rows = rows.select(*schema.fieldNames(), line.alias(BROKEN), *extra)
        frames.append(rows)
    if not frames:
        texts = T.StructType([T.StructField(n, T.StringType()) for n in (*schema.fieldNames(), BROKEN)])
        return spark.createDataFrame([], texts)
    return reduce(DataFrame.unionByName, frames)


def read_texts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The columns of a schema as text, found in every file by its own header in any order
    and case, and ``BROKEN``: the line, where it does not have as many fields as the header.
    A file without one of the columns is an error that names it. Further columns are not
    handed on."""
    return _texts(spark, path, schema, [])


def broken_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(file, line): the broken lines as they stand, to be kept aside and mended."""
    texts = _texts(spark, path, schema, [F.col("_metadata.file_path").alias("file")])
    if "file" not in texts.columns:
        texts = texts.withColumn("file", F.lit(None).cast("string"))
    return texts.filter(F.col(BROKEN).isNotNull()).select("file", F.col(BROKEN).alias("line"))


def whole_lines(texts: DataFrame, fail_on_broken: bool = False) -> DataFrame:
    """The lines that are not broken; on request a broken line is an error."""
    whole = F.col(BROKEN).isNull()
    if fail_on_broken:
        message = F.concat(F.lit("broken line: "), F.col(BROKEN))
        whole = F.when(whole, True).otherwise(F.raise_error(message).cast("boolean"))
    return texts.filter(whole).drop(BROKEN)


def typed(texts: DataFrame, schema: T.StructType, fail_on_bad: bool = False) -> DataFrame:
    """Text columns as the types of a schema. A value that cannot be read becomes NULL, which
    ``columns.value_audit`` counts, or an error on request."""

    def value(field):
        read = readable_value(field.name, field.dataType)
        if fail_on_bad:
            bad = texts[field.name].isNotNull() & read.isNull()
            message = F.concat(F.lit(f"unreadable {field.name}: "), texts[field.name])
            read = F.when(bad, F.raise_error(message)).otherwise(read)
        return read.alias(field.name)

    return texts.select(*[value(f) for f in schema])


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    header: bool = True,
    infer_schema: bool = False,
    fail_on_bad: bool = False,
    fail_on_broken: bool = True,
) -> DataFrame:
    """CSV by declared schema (columns found by each file's header), or inferred on request.
    By schema, lines with too few or too many fields are an error or left out."""
    reader = spark.read.option("header", header)
    if infer_schema or schema is None:
        return reader.option("inferSchema", infer_schema).csv(path)
    if not header:
        return reader.schema(schema).csv(path)
    lines = whole_lines(read_texts(spark, path, schema), fail_on_broken)
    return typed(lines, schema, fail_on_bad)


def read_sales(
    spark: SparkSession,
    path: str | None = None,
    infer_schema: bool = False,
    name: str = "sales_data",
    fail_on_bad: bool = False,
) -> DataFrame:
    """Raw sales lines, column names in lower case, also registered as a view. Broken lines
    are left out (``broken_lines`` has them), or an error on request as bad values are."""
    path = path or dataset_path()
    sales = lower_names(
        read_csv(
            spark,
            path,
            schemas.SALES_RAW,
            infer_schema=infer_schema,
            fail_on_bad=fail_on_bad,
            fail_on_broken=fail_on_bad,
        )
    )
    sales.createOrReplaceTempView(name)
    return sales


def read_sales_small(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The stored trailing window, or in either format raw lines without a parsed date."""
    if fmt == "csv":
        there = {c.lower() for header in csv_headers(spark, path).values() for c in header}
    else:
        there = {c.lower() for c in spark.read.format(fmt).load(path).columns}
    fields = [f for f in schemas.SALES_SMALL if f.name in there]
    fields += [f for f in schemas.SALES_RAW if f.name not in there]
    schema = T.StructType(fields)
    if fmt == "csv":
        return read_csv(spark, path, schema, fail_on_broken=False)
    return lower_names(spark.read.format(fmt).load(path)).select(*schema.fieldNames())


def read_weekly(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    name: str = "sales_data",
    memory: bool = False,
) -> DataFrame:
    """The weekly relation, also registered as a view; ``memory`` caches it for a session
    that reads it often."""
    if fmt == "csv":
        weekly = read_csv(spark, path, schemas.WEEKLY)
    else:
        weekly = spark.read.format(fmt).schema(schemas.WEEKLY).load(path)
    if memory:
        weekly = weekly.cache()
    weekly.createOrReplaceTempView(name)
    return weekly


def read_weekly_sums(spark: SparkSession, path: str) -> DataFrame:
    """Weekly sums as stored in a folder per week."""
    return spark.read.schema(schemas.WEEKLY_SUMS).parquet(path)


def stored_limits(spark: SparkSession, path: str, column: str = "date") -> DataFrame:
    """First and last value of a stored column and the number of rows, from the footers of the
    Parquet files: no data page is read. The reader that can do this is switched on in a
    session of its own, other reads stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(
        F.min(column).alias("first"), F.max(column).alias("last"), F.count("*").alias("row_count")
    )


def read_forecasts(
    spark: SparkSession, datastore_type: str, location: str | None = None
) -> DataFrame:
    """Forecasts from a ``csv`` or ``parquet`` path, or a ``table`` of the catalog."""
    if datastore_type == "csv":
        return read_csv(spark, location or forecast_path(), schemas.FORECASTS)
    if datastore_type == "parquet":
        return spark.read.schema(schemas.FORECASTS).parquet(location or forecast_path())
    if datastore_type == "table":
        return spark.table(location or "forecast_data")
    raise ValueError("Unsupported datastore type")


def register_result(df: DataFrame, name: str = "spark_df") -> DataFrame:
    """Make a result available by name, replacing an earlier one. Stays lazy."""
    df.createOrReplaceTempView(name)
    return df
