"""Counts taken by the running job itself, as rows pass: no second pass over the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfweek.functions import dates
from shelfweek.operators.columns import readable_value


def line_counts(schema: T.StructType, broken: str, date: str = "date") -> dict[str, Column]:
    """Lines read, broken, without a date or with one that cannot be read, and unreadable
    values per column, of text columns."""
    whole = F.col(broken).isNull()
    parsed = dates.parse_us_date(date)
    counts = {
        "lines": F.count(F.lit(1)),
        "broken": F.count_if(~whole),
        "undated": F.count_if(whole & F.col(date).isNull()),
        f"unreadable_{date}": F.count_if(whole & F.col(date).isNotNull() & parsed.isNull()),
    }
    for field in schema:
        if not isinstance(field.dataType, T.StringType):
            bad = F.col(field.name).isNotNull() & readable_value(field.name, field.dataType).isNull()
            counts[f"unreadable_{field.name}"] = F.count_if(whole & bad)
    return counts


def dated_counts(date: str = "date") -> dict[str, Column]:
    return {"lines": F.count(F.lit(1)), "undated": F.count_if(F.col(date).isNull())}


def watched(df: DataFrame, counts: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``df``, counted when it next runs to the end; ``get`` of the second waits for that."""
    seen = Observation()
    return df.observe(seen, *[c.alias(name) for name, c in counts.items()]), seen
