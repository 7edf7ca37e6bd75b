"""Landing and keyed upsert on Parquet.

A bronze table is partitioned by a function of its key, so a batch rewrites only the partitions it touches. The job's
commit replaces them one by one: readers may see a mix of old and new partitions for a moment, which is weaker than a
transaction. One writer per table at a time.

Every figure of a load is observed in the job that does the work: the landing counts what it leaves out, the merge
counts what it inserts and updates.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridmix.functions.instants import TimeWindow
from gridmix.functions.text import safe_run_id
from gridmix.operators.conform import conform
from gridmix.sources.tables import parted, timed
from gridmix.specs import LOAD_COLUMNS, PART, Dataset, layer_path


@dataclass(frozen=True)
class LoadResult:
    """Figures of one upsert; ``touched`` are the folders that were written, ``unchanged`` those that were left as they are."""

    rows_in_batch: int
    rows_merged: int
    rows_inserted: int
    rows_updated: int
    rows_deduplicated: int
    touched: tuple[str, ...] = ()
    unchanged: tuple[str, ...] = ()


def landed_path(folder: str, run_id: str, ingest_date: dt.date) -> str:
    return f"{folder.rstrip('/')}/ingest_date={ingest_date}/run_id={safe_run_id(run_id)}"


def land(df: DataFrame, folder: str, run_id: str, ingest_date: dt.date) -> str:
    """Immutable landing of one batch; a replay of the same run replaces that run only. An empty batch is landed as well:
    a file with its schema, which Spark's first task writes whatever it gets. Returns where."""
    path = landed_path(folder, run_id, ingest_date)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def latest(batch: DataFrame, keys: list[str], measures: list[str], newest: str = "ingested_at_utc") -> DataFrame:
    """One row per key: the newest, then the one with most measures, then the last to arrive (_seq, where there is one)."""
    full = reduce(add, [F.col(m).isNotNull().cast("int") for m in measures], F.lit(0))
    order = [F.col(newest).desc(), full.desc(), *([F.col("_seq").desc()] if "_seq" in batch.columns else [])]
    numbered = batch.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return numbered.where("_rn = 1").drop("_rn")


def merged(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the target that the batch doesn't replace, and the batch."""
    return target.join(batch.select(*keys), keys, "left_anti").unionByName(batch)


def upsert_metrics(target: DataFrame, batch: DataFrame, unique: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows_in_batch, rows_merged, rows_inserted, rows_updated, rows_deduplicated."""
    n = F.count(F.lit(1)).cast("long")
    known = target.select(*keys).distinct().withColumn("_known", F.lit(True))
    m = unique.select(*keys).join(known, keys, "left").agg(n.alias("rows_merged"), F.count("_known").cast("long").alias("rows_updated"))
    out = batch.agg(n.alias("rows_in_batch")).crossJoin(m)  # one row each
    return out.select("rows_in_batch", "rows_merged", (F.col("rows_merged") - F.col("rows_updated")).alias("rows_inserted"), "rows_updated", (F.col("rows_in_batch") - F.col("rows_merged")).alias("rows_deduplicated"))


def contents(rows: DataFrame, spec: Dataset) -> DataFrame:
    """Count and sum of hashes of the rows of each folder: what was loaded when and from where doesn't count."""
    own = [c for c in spec.stored.fieldNames() if c not in LOAD_COLUMNS.fieldNames()]
    return rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*own).cast("decimal(38,0)")).alias("h"))


def one_merge(old: DataFrame, batch: DataFrame, spec: Dataset, figures: Observation) -> DataFrame:
    """Old rows and the batch's unique rows in one full outer join, whose flags give the figures as it runs."""
    keys, rest = list(spec.key), [c for c in spec.stored.fieldNames() if c not in spec.key]
    now = batch.select(*keys, F.struct(*rest).alias("_now"), F.lit(True).alias("_is_now"))
    before = old.select(*keys, F.struct(*rest).alias("_before"), F.lit(True).alias("_is_before"))
    both = before.join(now, keys, "full_outer")
    both = both.observe(figures, F.count("_is_now").alias("merged"), F.count(F.when(F.col("_is_now") & F.col("_is_before"), 1)).alias("updated"))
    value = lambda c: F.when(F.col("_is_now"), F.col(f"_now.{c}")).otherwise(F.col(f"_before.{c}")).alias(c)
    return both.select(*keys, *map(value, rest))


def upsert(spark: SparkSession, base: str, spec: Dataset, batch: DataFrame, skip_unchanged: bool = False) -> LoadResult:
    """Merges a batch into the bronze table of a dataset; the last batch loaded wins. Replays change nothing.

    Only folders that the batch touches are read, once, and written. Rows are dealt to tasks by folder; Spark splits
    large folders and joins small ones by their sizes as they are. Inside a file rows are sorted by key. With
    ``skip_unchanged``, for batches that hold whole folders again, a folder whose count and sum of row hashes are those
    of the batch is neither merged nor written: its rows keep the time they were loaded first.
    """
    folders = {r[0]: r[1] for r in batch.groupBy(spec.part()).count().collect()}  # a row a folder
    touched, skipped, kept = sorted(folders), [], 0
    if skip_unchanged and folders:
        unique = latest(batch, list(spec.key), list(spec.numbers)).select(*spec.stored.fieldNames()).withColumn(PART, spec.part())
        new = {r[PART]: (r["n"], r["h"]) for r in contents(unique, spec).collect()}
        stored = parted(spark, base, spec).where(F.col(PART).isin(*folders))
        skipped = sorted(r[PART] for r in contents(stored, spec).collect() if new[r[PART]] == (r["n"], r["h"]))
        touched, kept = sorted(new.keys() - set(skipped)), sum(new[p][0] for p in skipped)
    merged_rows, updated, n = 0, 0, sum(folders.values())
    if touched:
        figures = Observation()
        old = parted(spark, base, spec).where(F.col(PART).isin(*touched))
        fresh = latest(batch, list(spec.key), list(spec.numbers)).select(*spec.stored.fieldNames())
        fresh = fresh.where(spec.part().isin(*touched)) if skipped else fresh
        out = one_merge(old, fresh, spec, figures).withColumn(PART, spec.part())
        out = out.hint("rebalance", PART).sortWithinPartitions(PART, *spec.key)
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(PART).parquet(layer_path(base, "bronze", spec.table))
        merged_rows, updated = figures.get["merged"], figures.get["updated"]  # more, if a lost executor's tasks ran again
    return LoadResult(n, merged_rows + kept, merged_rows - updated, updated + kept, n - merged_rows - kept, tuple(touched), tuple(skipped))


def ingest(spark: SparkSession, base: str, spec: Dataset, records: DataFrame, ingested_at: dt.datetime, run_id: str, window: TimeWindow | None = None, skip_unchanged: bool = False) -> dict:
    """Conform, land, upsert. Figures of the load: the dataset's name, rows that were typed, those left out and why,
    values that couldn't be read by column, missing columns, folders written. A window is an error for a dataset
    without instants, before any job; otherwise rows outside it are left out."""
    observed = Observation()
    typed = conform(records, spec, ingested_at, observed=observed)
    rows = typed.rows.where(window.holds(timed(spec))) if window else typed.rows
    landed = land(rows, f"{base.rstrip('/')}/landing/{spec.table}", run_id, ingested_at.date())
    seen = observed.get
    result = upsert(spark, base, spec, spark.read.schema(rows.schema).parquet(landed), skip_unchanged)
    unreadable = {c: seen[f"unreadable_{c}"] for c in spec.numbers if f"unreadable_{c}" in seen}
    return {"dataset_id": spec.name, "rows": result.rows_in_batch, **result.__dict__, "records": seen["records"], "without_key": seen["without_key"], "in_gap": seen["in_gap"], "unreadable": unreadable, "missing": typed.missing}
