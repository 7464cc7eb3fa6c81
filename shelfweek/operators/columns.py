"""Column-level steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfweek.functions import dates


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name; names that then clash are an error."""
    names = [c.lower() for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"columns differ only by case: {clash}")
    return df.toDF(*names)


def column_list(df: DataFrame, sep: str = ",") -> str:
    return sep.join(df.columns)


def add_calendar(df: DataFrame, date: str = "date") -> DataFrame:
    """Parsed date and calendar parts next to the text date."""
    parsed = df.withColumn("date_parsed", dates.parse_us_date(date))
    return parsed.withColumns(dates.calendar_columns("date_parsed"))


def replace_text_date(df: DataFrame, date: str = "date", iso: bool = False) -> DataFrame:
    parse = dates.parse_iso_date if iso else dates.parse_us_date
    return df.withColumn(date, parse(date))


def add_week(df: DataFrame, date: str = "date", name: str = "week") -> DataFrame:
    return df.withColumn(name, dates.week_start(date))


def add_quarter(df: DataFrame, date: str = "Date", name: str = "Quarter") -> DataFrame:
    return df.withColumn(name, dates.quarter_label(date))


def date_audit(df: DataFrame, date: str = "date") -> DataFrame:
    """How many rows have a text date that cannot be read, and how many have none."""
    parsed = dates.parse_us_date(date)
    return df.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col(date).isNull()).alias("missing_dates"),
        F.count_if(F.col(date).isNotNull() & parsed.isNull()).alias("unreadable_dates"),
    )


def readable_value(column: str, kind: T.DataType) -> Column:
    """A text column as a type, NULL where it does not read as one; infinities do not."""
    value = F.col(column).try_cast(kind)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = F.when(F.abs(value) < float("inf"), value)
    return value


def value_audit(
    texts: DataFrame,
    schema: T.StructType,
    date: str | None = "date",
    broken: str | None = None,
) -> DataFrame:
    """Per column of a schema how many text values are missing and how many cannot be read;
    ``date`` names a text column that should hold month/day/year dates. ``broken`` names a
    column that holds lines that are broken: a row ``(line)`` counts all lines and the broken
    ones, and the columns are judged by the others. One pass."""
    whole = F.lit(True) if broken is None else F.col(broken).isNull()

    def counts(field):
        value = readable_value(field.name, field.dataType)
        if field.name == date:
            value = dates.parse_us_date(field.name)
        text = F.col(field.name)
        return [
            F.count_if(whole & text.isNull()).alias(f"{field.name}_missing"),
            F.count_if(whole & text.isNotNull() & value.isNull()).alias(
                f"{field.name}_unreadable"
            ),
        ]

    sums = texts.agg(
        F.count("*").alias("_rows"),
        F.count_if(whole).alias("_whole"),
        *[c for f in schema for c in counts(f)],
    )

    def row(name, *values):
        names = ("row_count", "missing", "unreadable")
        return F.struct(
            F.lit(name).alias("column_name"), *[v.alias(n) for v, n in zip(values, names)]
        )

    rows = [
        row(f.name, F.col("_whole"), F.col(f"{f.name}_missing"), F.col(f"{f.name}_unreadable"))
        for f in schema
    ]
    if broken is not None:
        none = F.lit(0).cast("long")
        rows.append(row("(line)", F.col("_rows"), none, F.col("_rows") - F.col("_whole")))
    return sums.select(F.inline(F.array(*rows)))
