"""Raw records to the schema of a spec."""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix.functions.instants import resolve_instants
from gridmix.functions.text import clean_text, is_unreadable, to_measure
from gridmix.specs import Dataset

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Conformed:
    """Typed rows, rows of the raw batch left out, and the names of missing columns."""

    rows: DataFrame
    without_key: DataFrame
    in_gap: DataFrame
    missing: list[str]


def _typed(df: DataFrame, spec: Dataset, name: str) -> Column:
    kind = spec.type_of(name)
    if name not in df.columns:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.DoubleType):
        return to_measure(F.col(name), isinstance(df.schema[name].dataType, T.BooleanType))
    return clean_text(F.col(name)) if isinstance(kind, T.StringType) else F.col(name)


def conform(records: DataFrame, spec: Dataset, ingested_at: dt.datetime, strict: bool = False, observed: Observation | None = None) -> Conformed:
    """Typed rows of a spec from records of texts in arrival order (_seq).

    Missing columns become null and unknown ones go. Rows without a whole key are left out and given back, as are rows
    at a local time that doesn't exist; with ``strict`` the latter end the job. ``observed`` gets, from the first job
    that uses the rows: records, without_key, in_gap, and unreadable_<column> of each measure.
    """
    if ingested_at.tzinfo is None:
        raise ValueError("ingested_at must be aware")
    missing = [c for c in spec.columns if c not in records.columns]
    if missing:
        log.warning("%s: missing columns %s", spec.name, missing)
    if "_seq" not in records.columns:
        records = records.withColumn("_seq", F.monotonically_increasing_id())
    df = records
    if spec.time and spec.time in df.columns:
        # A blank attribute of the key doesn't make a series of its own.
        cleaned = df.withColumns({c: clean_text(F.col(c)) for c in [spec.time, *spec.series] if c in df.columns})
        df = resolve_instants(cleaned, spec.time, [c for c in spec.series if c in df.columns])
    else:
        df = df.withColumn("_gap", F.lit(False))
    if strict:
        df = df.withColumn("_gap", F.when(F.col("_gap"), F.raise_error(F.lit(f"{spec.name}: a local time that does not exist"))).otherwise(F.lit(False)))
    whole = F.lit(True)
    for k in spec.key:
        whole = whole & F.col(k).isNotNull()
    read = [c for c in spec.numbers if c in df.columns]
    flags = [is_unreadable(F.col(c)).alias(f"_unreadable_{c}") for c in read if observed]
    typed = df.select(*(_typed(df, spec, c).alias(c) for c in spec.columns), "_seq", "_gap", *flags)
    typed = typed.withColumns({"ingested_at_utc": F.lit(ingested_at), "source_dataset": F.lit(spec.name)})
    names = [*spec.stored.fieldNames(), "_seq"]
    rows = typed
    if observed:
        times = lambda c: F.count(F.when(c, 1))
        unreadable = [times(F.col(f"_unreadable_{c}")).alias(f"unreadable_{c}") for c in read]
        rows = typed.observe(observed, F.count(F.lit(1)).alias("records"), times(~whole & ~F.col("_gap")).alias("without_key"), times(F.col("_gap")).alias("in_gap"), *unreadable)
    good = rows.where(whole & ~F.col("_gap")).select(*names)
    return Conformed(good, typed.where(~whole & ~F.col("_gap")).select(*names), typed.where("_gap").select(*names), missing)
