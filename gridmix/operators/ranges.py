"""Joins on half-open ranges [low, high) with an open end where high is null: grids with validity, bands of numbers.

Up to ``MOST`` ranges are sent to every task. More are joined by buckets: a range stands under every bucket that it
covers, a row under its own, and rows of a bucket are compared by value. ``bucket`` is any function of a value that
never falls as the value grows and that gives a range few buckets; it decides about work only, never about results.
A key and bucket with very many rows is split by Spark's skew join, as every row meets each range once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges that are broadcast at most.
MOST = 10_000


def by_month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def by_size(number: Column) -> Column:
    """Eight buckets for each doubling of a number's size; negative numbers mirror positive ones."""
    steps = F.floor(8 * F.log2(F.greatest(F.abs(number), F.lit(2.0**-60)))).cast("int") + 481
    return F.when(number < 0, -steps).otherwise(steps)


def by_value(number: Column) -> Column:
    """For whole numbers of a small span, such as hours of a day."""
    return number.cast("int")


def range_join(rows: DataFrame, ranges: DataFrame, value: str, low: str, high: str, bucket: Callable[[Column], Column], on: dict[str, str] | None = None, how: str = "left", most: int = MOST) -> DataFrame:
    """Rows with the columns of the ranges that hold their value and agree in ``on`` (row column: range column), but for
    low, high and the columns of ``on``. Rows in several ranges come several times; a null value or low is in none."""
    named = ranges.select(*(F.col(c).alias(f"_r_{c}") for c in ranges.columns))
    at, first, end = F.col(value), F.col(f"_r_{low}"), F.col(f"_r_{high}")
    holds = (at >= first) & (end.isNull() | (at < end))
    for a, b in (on or {}).items():
        holds = (F.col(a) == F.col(f"_r_{b}")) & holds
    gone = [f"_r_{c}" for c in (low, high, *(on or {}).values())]
    if named.limit(most + 1).count() <= most:
        out = rows.join(F.broadcast(named), holds, how)  # its size has just been checked
    else:
        # Open ends reach to a bucket after all that the ranges name, and so do rows beyond it.
        last = named.agg(F.max(F.greatest(bucket(first), bucket(end)))).first()[0] + 1
        stop = F.when(end.isNull(), F.lit(last)).otherwise(bucket(end))
        spread = named.where(end.isNull() | (first < end)).withColumn("_r_bucket", F.explode(F.sequence(bucket(first), stop)))
        own = rows.withColumn("_bucket", F.least(bucket(at), F.lit(last)))
        out = own.join(spread, (F.col("_bucket") == F.col("_r_bucket")) & holds, how).drop("_bucket", "_r_bucket")
    return out.drop(*gone).withColumnsRenamed({f"_r_{c}": c for c in ranges.columns if f"_r_{c}" not in gone})
