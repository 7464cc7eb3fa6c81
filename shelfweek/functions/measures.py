"""Order-free sums of money and volume.

Sums of doubles depend on the order rows arrive in, which changes from run to run on a
cluster. A measure is therefore added as two whole numbers, its whole part and its fraction
in 1/10^9: exact, the same for any partitioning, and far faster than a decimal sum. A total
that does not fit raises an error, whatever ``spark.sql.ansi.enabled`` says. NaN and
infinities count as missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FRACTIONS = 1_000_000_000
# beyond this a double has no fraction, and its whole part soon none in a long
LARGEST = 1e18


def readable(c: str | Column) -> Column:
    """The measure as a double, NULL for NaN and infinities."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def total(c: str | Column) -> Column:
    """Sum that skips NULL, NaN and infinities; NULL for a group without any value."""
    x = readable(c)
    x = F.when(F.abs(x) < LARGEST, x).when(
        x.isNotNull(), F.raise_error(F.lit("a measure is too large to be added exactly"))
    )
    whole = F.floor(x)
    whole_sum = F.try_sum(whole)
    part_sum = F.try_sum(F.rint((x - whole) * FRACTIONS).cast("bigint"))
    value = whole_sum.cast("decimal(19,0)") + part_sum.cast("decimal(19,0)") * F.lit(
        "0.000000001"
    ).cast("decimal(9,9)")
    lost = (F.count(whole) > 0) & (whole_sum.isNull() | part_sum.isNull())
    return F.when(
        lost, F.raise_error(F.lit("a total is too large to be added exactly"))
    ).otherwise(value.cast("double"))


def total_or_zero(c: str | Column) -> Column:
    """As ``total``, but 0 for a group without any value."""
    return F.coalesce(total(c), F.lit(0.0))
