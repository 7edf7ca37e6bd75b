"""Window operators on hourly series: sliding windows, islands, disjoint best windows, overlap checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def sliding_windows(hours: DataFrame, n: int, group: str = "mois", time: str = "heure_utc", value: str = "taux_co2_g_kwh", price: str = "prix_ttc_eur_kwh") -> DataFrame:
    """Windows of n rows from each row on, inside a group: means, counts and the last time. n must be 1 or more."""
    if n < 1:
        raise ValueError(f"a window needs an hour or more, not {n}")
    w = W.partitionBy(group).orderBy(time).rowsBetween(0, n - 1)
    return hours.withColumns({"prix_moyen": F.avg(price).over(w), "co2_moyen": F.avg(value).over(w), "nb_mesurees": F.count(value).over(w), "nb_prix": F.count(price).over(w), "derniere": F.last(time).over(w)})


def complete_windows(windows: DataFrame, n: int, time: str = "heure_utc") -> DataFrame:
    """Windows of n measured hours without a hole."""
    return windows.where((F.col("nb_mesurees") == n) & (F.col("derniere") == F.col(time) + F.make_dt_interval(hours=F.lit(n - 1))))


def priced_where_known(windows: DataFrame, hours: DataFrame, n: int, group: str = "mois", price: str = "prix_ttc_eur_kwh") -> DataFrame:
    """Fully priced windows in groups that have any price, all windows in the others; adds ``avec_prix``."""
    known = hours.groupBy(group).agg((F.count(price) > 0).alias("avec_prix"))
    return windows.join(F.broadcast(known), group).where(~F.col("avec_prix") | (F.col("nb_prix") == n))  # a row per month


def disjoint_best(rows: DataFrame, group: str, order: list[Column], k: int, start: Column, length: Column, columns: list[str]) -> DataFrame:
    """Greedy choice of up to k windows per group in a given order, skipping those that overlap a chosen one.

    Each group is one array: at most a month of hours here. ``order`` are columns whose ascending order ranks rows.
    """
    keys = [c.alias(f"o{i}") for i, c in enumerate(order)]
    item = F.struct(*keys, start.alias("a"), (start + length).alias("b"), *columns)
    ranked = rows.groupBy(group).agg(F.sort_array(F.collect_list(item)).alias("all"))

    def step(kept: Column, x: Column) -> Column:
        overlaps = F.exists(kept, lambda y: (x["a"] < y["b"]) & (y["a"] < x["b"]))
        return F.when((F.size(kept) < k) & ~overlaps, F.array_append(kept, x)).otherwise(kept)

    kept = F.aggregate("all", F.filter("all", lambda x: F.lit(False)), step)
    out = ranked.select(group, F.posexplode(kept).alias("pos", "x"))
    return out.select(group, (F.col("pos") + 1).cast("long").alias("rang"), *(F.col(f"x.{c}").alias(c) for c in columns))


def islands(rows: DataFrame, group: str, time: str = "heure_utc") -> DataFrame:
    """Adds ``ilot``, equal for consecutive hours of a group."""
    rn = F.row_number().over(W.partitionBy(group).orderBy(time))
    return rows.withColumn("ilot", F.col(time) - F.make_dt_interval(hours=rn))


def overlaps(rows: DataFrame, start: str, minutes: str) -> DataFrame:
    """Intervals [start, start + minutes) that reach into the next one, without a window over the whole table.

    Rows are cut by day; the last row of a day is compared with the first of the next day that has any (one row per day).
    """
    rows = rows.withColumn("_day", F.to_date(start))
    inside = rows.withColumn("_next", F.lead(start).over(W.partitionBy("_day").orderBy(start)))
    days = rows.groupBy("_day").agg(F.min(start).alias("_first"))
    following = days.withColumn("_first_after", F.lead("_first").over(W.orderBy("_day"))).drop("_first")
    joined = inside.join(following, "_day").withColumn("suivant", F.coalesce("_next", "_first_after"))
    return joined.where(F.col("suivant") < F.col(start) + F.make_dt_interval(mins=F.col(minutes).cast("int"))).drop("_day", "_next", "_first_after")


def rank_where(value: str, condition: Column) -> Column:
    """Rank by descending value among rows that meet a condition; null elsewhere."""
    return F.when(condition, F.rank().over(W.partitionBy(condition).orderBy(F.col(value).desc())).cast("long"))
