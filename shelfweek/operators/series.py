"""Steps on weekly series. One series has at most one row per calendar week."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfweek.functions import dates
from shelfweek.operators.filters import max_value
from shelfweek.session import task_slots
from shelfweek.sinks.files import settle

PAIR = ["store_number", "category_name"]


def active_series(weekly: DataFrame, last: Column | None = None) -> DataFrame:
    """Keep the (store, category) series that have a row in the last week.

    A window maximum instead of a semi join: the weekly relation is computed once, and
    NULL keys form a group of their own. ``last`` may pass the last week as a scalar
    found more cheaply than from the weekly relation.
    """
    last = max_value(weekly, "date") if last is None else last
    newest = F.max("date").over(Window.partitionBy(*PAIR))
    return weekly.withColumn("_newest", newest).filter(F.col("_newest") == last).drop("_newest")


def active_series_by_join(weekly: DataFrame) -> DataFrame:
    """The same by a NULL-safe semi join, as a cross-check."""
    last_rows = weekly.filter(F.col("date") == max_value(weekly, "date"))
    keys = last_rows.select(*[F.col(c).alias(f"_{c}") for c in PAIR]).distinct()
    same = [weekly[c].eqNullSafe(keys[f"_{c}"]) for c in PAIR]
    return weekly.join(keys, same[0] & same[1], "left_semi")


def store_blocks(per_store: DataFrame, blocks: int | None = None) -> DataFrame:
    """(store_number, n, _block): the stores, in store order, cut into blocks of about equal
    numbers of stores. Settled, as cutting anew could cut elsewhere."""
    place = F.asc_nulls_last("store_number")
    cut = per_store.repartitionByRange(blocks or max(task_slots(per_store), 1), place)
    return settle(cut.withColumn("_block", F.spark_partition_id()))


def store_offsets(per_store: DataFrame, blocks: int | None = None) -> DataFrame:
    """Number of series before each store in store order, from (store_number, n).

    A running sum over all stores would pass through one task. Only the sums of the blocks
    are summed up in one place.
    """
    placed = store_blocks(per_store, blocks)
    sums = placed.groupBy("_block").agg(F.sum("n").alias("_sum"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start")
    )
    inside = (
        Window.partitionBy("_block")
        .orderBy(F.asc_nulls_last("store_number"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # a row per block, as many as there are shuffle partitions
    return (
        placed.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(F.broadcast(starts), "_block")
        .select("store_number", (F.col("_start") + F.col("_inside")).alias("_offset"))
    )


def series_numbers(weekly: DataFrame) -> DataFrame:
    """Each distinct (store, category) with its number 1..n in key order, NULLs last."""
    keys = weekly.select(*PAIR).distinct()
    in_store = Window.partitionBy("store_number").orderBy(F.asc_nulls_last("category_name"))
    ranked = keys.withColumn("_pos", F.row_number().over(in_store))
    per_store = keys.groupBy("store_number").agg(F.count("*").alias("n"))
    offsets = store_offsets(per_store).withColumnRenamed("store_number", "_store")
    return ranked.join(offsets, F.col("store_number").eqNullSafe(F.col("_store"))).select(
        *PAIR, (F.col("_offset") + F.col("_pos")).cast("int").alias("srl_num")
    )


def number_series(weekly: DataFrame) -> DataFrame:
    """Add ``srl_num`` to every row of its series."""
    numbers = series_numbers(weekly).toDF("_store", "_category", "srl_num")
    same = F.col("store_number").eqNullSafe(F.col("_store")) & F.col("category_name").eqNullSafe(
        F.col("_category")
    )
    return weekly.join(numbers, same).drop("_store", "_category")


def fill_gaps(
    weekly: DataFrame, first: Column | None = None, last: Column | None = None
) -> DataFrame:
    """Give every series a row for every week of the whole range, 0 where it had none.

    Only pairs that occur are filled. Each row fills the weeks up to the next one, the first
    and last also those to the ends of the range, so no grid is built and nothing is joined.
    """
    first = weekly.agg(F.min("date")).scalar() if first is None else first
    last = max_value(weekly, "date") if last is None else last
    w = Window.partitionBy(*PAIR).orderBy("date")
    spans = weekly.withColumns(
        {
            "_from": F.when(F.lag("date").over(w).isNull(), first).otherwise(F.col("date")),
            "_next": F.lead("date").over(w),
        }
    ).withColumn("_to", F.coalesce(F.date_sub("_next", 7), last))
    weeks = spans.withColumn(
        "_week", F.explode(F.sequence("_from", "_to", F.expr("interval 7 days")))
    )
    own = F.col("_week") == F.col("date")
    return weeks.select(
        *PAIR,
        F.col("_week").alias("date"),
        F.when(own, F.col("total_sales")).otherwise(0.0).alias("total_sales"),
        F.when(own, F.col("total_volume_sold")).otherwise(0.0).alias("total_volume_sold"),
    )


def positions(series: DataFrame, keys: list[str], date: str = "date") -> DataFrame:
    """Place of each row in its series, and the series' last date."""
    w = Window.partitionBy(*keys)
    return series.withColumns(
        {
            "position": F.row_number().over(w.orderBy(date)),
            "last_date": F.max(date).over(w),
        }
    )


def nest(series: DataFrame, keys: list[str], columns: list[str], name: str = "data") -> DataFrame:
    """One row per series with its rows as an array, in order of the first column."""
    rows = F.sort_array(F.collect_list(F.struct(*columns)))
    return series.groupBy(*keys).agg(rows.alias(name))


def unnest(nested: DataFrame, name: str = "data") -> DataFrame:
    keys = [c for c in nested.columns if c != name]
    return nested.select(*keys, F.inline(name))


def spread_by_keys(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Hash the rows by key into a stated number of partitions.

    With no number given Spark may merge the small partitions of a weekly relation into
    one task, which is wrong before per-series work that is heavy on the processor.
    """
    return df.repartition(partitions or task_slots(df), *keys)


def apply_per_series(
    series: DataFrame,
    keys: list[str],
    fn: Callable,
    schema: str,
    date: str = "date",
    partitions: int | None = None,
) -> DataFrame:
    """Run a pandas function on every series, its rows sorted by date.

    The function returns the value columns; the keys are put in front of them.
    """

    def run(key, pdf):
        out = fn(pdf.sort_values(date, kind="stable").reset_index(drop=True))
        for i, (name, value) in enumerate(zip(keys, key)):
            out.insert(i, name, value)
        return out

    types = dict(series.dtypes)
    head = ", ".join(f"`{k}` {types[k]}" for k in keys)
    spread = spread_by_keys(series, keys, partitions)
    return spread.groupBy(*keys).applyInPandas(run, f"{head}, {schema}")


def forecast_calendar(
    series: DataFrame, keys: list[str], horizon: int = 18, first_step: str = "last"
) -> DataFrame:
    """Future weekly dates of each series; NULL dates are ignored.

    ``first_step='last'`` dates the first step at the last observed week, as published
    forecasts do; ``'next'`` at the week after it.
    """
    start = F.date_add(F.max("date"), step_shift(first_step))
    ends = series.filter(F.col("date").isNotNull()).groupBy(*keys).agg(start.alias("_start"))
    return ends.select(
        *keys, F.explode(dates.weekly_dates(F.col("_start"), horizon)).alias("Date")
    )


def step_shift(first_step: str) -> int:
    if first_step not in ("last", "next"):
        raise ValueError(f"first_step is 'last' or 'next', not {first_step!r}")
    return 7 if first_step == "next" else 0
