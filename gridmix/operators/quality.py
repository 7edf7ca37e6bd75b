"""Data-quality checks: offending rows, and all checks of a table counted in one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def not_unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Combinations that occur more than once; nulls are equal to each other."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).cast("long").alias("n")).where("n > 1")


def is_null(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(column: str, values: list) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def out_of_range(column: str, least=None, most=None) -> Column:
    """Nulls pass; either bound may be left out."""
    out = F.lit(False)
    if least is not None:
        out = out | (F.col(column) < least)
    if most is not None:
        out = out | (F.col(column) > most)
    return F.col(column).isNotNull() & out


def wrong_length(column: str, n: int) -> Column:
    return F.col(column).isNotNull() & (F.length(column) != n)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose value has no parent; nulls pass."""
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.where(F.col(column).isNotNull()).join(known, column, "left_anti")


@dataclass(frozen=True)
class Check:
    """A row condition that finds offenders, with its severity (warn or error)."""

    name: str
    offends: Column
    severity: str = "error"


def summary(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check: its offenders, counted in a single pass, and severity and verdict."""
    counts = df.agg(*(F.count(F.when(c.offends, 1)).cast("long").alias(f"c{i}") for i, c in enumerate(checks)))
    rows = F.array(*(F.struct(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), F.col(f"c{i}").alias("violations")) for i, c in enumerate(checks)))
    return counts.select(F.inline(rows)).withColumn("verdict", F.when(F.col("violations") == 0, "pass").otherwise(F.col("severity")))


def mismatched_hierarchy(df: DataFrame, derived: str, published: str) -> DataFrame:
    """Rows where both are known and differ."""
    return df.where(F.col(derived) != F.col(published))


def freshness(df: DataFrame, instant: str, measure: str, now: Column, limit_hours: float) -> DataFrame:
    """Latest instant, latest measured instant, rows, lag of the measured one and the verdict, as one row."""
    measured = F.max(F.when(F.col(measure).isNotNull(), F.col(instant)))
    out = df.agg(F.max(instant).alias("dernier"), measured.alias("dernier_mesure"), F.count(F.lit(1)).cast("long").alias("nb_lignes"))
    lag = F.timestamp_diff("MINUTE", F.col("dernier_mesure"), now) / F.lit(60.0)
    verdict = F.when(F.col("nb_lignes") == 0, "vide").when(F.col("dernier_mesure").isNull(), "sans_mesure").when(F.col("retard_heures") > limit_hours, "en_retard").otherwise("ok")
    return out.withColumn("retard_heures", lag).withColumn("verdict", verdict)


def month_coverage(df: DataFrame, instant: str, minutes: int, today: Column, least: float = 0.95) -> DataFrame:
    """Coverage of the latest whole month: the month of the latest instant, or the one before if that is the current one.

    Blank rows count: coverage tells what was published, freshness what was measured.
    """
    from gridmix.functions.instants import month_of, month_slots, paris_day

    month = month_of(paris_day(F.col(instant)))
    last = df.agg(F.max(month).alias("m")).select(F.when(F.col("m") == F.trunc(today, "MM"), F.add_months("m", -1)).otherwise(F.col("m")).alias("mois"))
    found = df.withColumn("mois", month).join(F.broadcast(last), "mois").groupBy("mois").agg(F.count_distinct(instant).cast("long").alias("nb_instants"))
    full = last.join(found, "mois", "left").select("mois", F.coalesce("nb_instants", F.lit(0)).alias("nb_instants"), month_slots(F.col("mois"), minutes).alias("nb_attendus"))
    out = full.withColumn("couverture", F.col("nb_instants") / F.col("nb_attendus"))
    return out.withColumn("verdict", F.when(F.col("couverture") >= least, "ok").otherwise("incomplet"))


def unsorted_files(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Files of a stored table whose rows don't stand in the order of their keys, with the number of rows that break it.
    The window is cut by file and by blocks of rows, so a large file isn't one group; first rows of blocks are compared
    with the last ones of the blocks before."""
    at = rows.select("_metadata.file_path", "_metadata.row_index", F.struct(*keys).alias("k")).withColumn("block", F.floor(F.col("row_index") / 100_000))
    own = W.partitionBy("file_path", "block").orderBy("row_index")
    inside = at.withColumn("before", F.lag("k").over(own)).where(F.col("k") < F.col("before")).groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
    ends = at.groupBy("file_path", "block").agg(F.min_by("k", "row_index").alias("first"), F.max_by("k", "row_index").alias("last"))
    edges = ends.withColumn("before", F.lag("last").over(W.partitionBy("file_path").orderBy("block"))).where(F.col("first") < F.col("before")).groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
    return inside.unionByName(edges).groupBy("file_path").agg(F.sum("n").alias("n"))
