"""Exact quantiles of groups of any size.

Spark's ``percentile`` keeps all different values of a group in one task. Here a histogram of each group (counts are
added up before they are shuffled) finds the bins with the two ranks that a continuous quantile lies between; only the
values of these bins are counted one by one and put in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BINS = 1 << 14


def exact_quantile(rows: DataFrame, group: str, value: str, q: float, bins: int = BINS) -> DataFrame:
    """(group, quantile) of finite numbers, equal to ``percentile``; null values don't count, groups without one have no
    row. Of a bin, a task holds the different values: very uneven values call for more bins."""
    if not 0 <= q <= 1:
        raise ValueError("a quantile lies between 0 and 1")
    v = F.col(value).cast("double")
    own = rows.select(F.col(group).alias("g"), v.alias("v")).where("v is not null")
    ends = own.groupBy(F.col("g").alias("_g")).agg(F.min("v").alias("low"), F.max("v").alias("top"), F.count(F.lit(1)).alias("n"))
    ends = ends.withColumn("place", F.lit(float(q)) * (F.col("n") - 1))
    share = (F.col("v") - F.col("low")) / F.nullif(F.col("top") - F.col("low"), F.lit(0.0))
    binned = own.join(ends, F.col("g").eqNullSafe(F.col("_g"))).drop("_g").withColumn("bin", F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1)).cast("int"))
    upto = lambda *by: W.partitionBy("g", *by[:-1]).orderBy(by[-1]).rowsBetween(W.unboundedPreceding, W.currentRow)
    counts = binned.groupBy("g", "bin").agg(F.count(F.lit(1)).alias("c"), F.first("place").alias("place")).withColumn("upto", F.sum("c").over(upto("bin")))
    # Ranks count from 0; a bin holds those from upto - c to upto - 1.
    holds = lambda rank: (F.col("upto") - F.col("c") <= rank) & (rank < F.col("upto"))
    wanted = counts.where(holds(F.floor("place")) | holds(F.ceil("place"))).select(F.col("g").alias("_g"), F.col("bin").alias("_bin"), (F.col("upto") - F.col("c")).alias("before"))
    inside = binned.join(wanted, F.col("g").eqNullSafe(F.col("_g")) & (F.col("bin") == F.col("_bin")))
    values = inside.groupBy("g", "bin", "before", "place", "v").agg(F.count(F.lit(1)).alias("c")).withColumn("upto", F.col("before") + F.sum("c").over(upto("bin", "v")))
    at = lambda rank: F.max(F.when(holds(rank), F.col("v")))
    found = values.groupBy("g", "place").agg(at(F.floor("place")).alias("a"), at(F.ceil("place")).alias("b"))
    low, high = F.floor("place"), F.ceil("place")
    between = F.when((low == high) | (F.col("a") == F.col("b")), F.col("a")).otherwise((high - F.col("place")) * F.col("a") + (F.col("place") - low) * F.col("b"))
    return found.select(F.col("g").alias(group), between.alias("quantile"))
