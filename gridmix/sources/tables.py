"""Stored tables of the three layers."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import StringType, StructType

from gridmix.functions.instants import TimeWindow
from gridmix.specs import DATASETS, PART, Dataset, layer_path


class MissingTable(RuntimeError):
    """A table that a product needs has not been built."""


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _there(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, on any file system that Spark reads."""
    system, at = _at(spark, path)
    return system.exists(at)


def parted(spark: SparkSession, base: str, spec: Dataset) -> DataFrame:
    """The bronze table of a dataset under its declared schema, with the column that splits it, so that filters on that
    column leave out folders; empty if nothing has been loaded yet."""
    schema = StructType(spec.stored.fields).add(PART, StringType())
    path = layer_path(base, "bronze", spec.table)
    return spark.read.schema(schema).parquet(path) if _there(spark, path) else spark.createDataFrame([], schema)


def bronze(spark: SparkSession, base: str, spec: Dataset, window: TimeWindow | None = None) -> DataFrame:
    """The bronze table of a dataset, in a time window if one is given."""
    rows = parted(spark, base, spec)
    return (windowed(rows, spec, window) if window else rows).drop(PART)


def timed(spec: Dataset) -> str:
    """The column of a dataset's instants. Without one there are no windows: an error, before any job."""
    if spec.time is None:
        raise ValueError(f"{spec.name} has no instants: it is read whole, not by a window")
    return spec.time


def windowed(rows: DataFrame, spec: Dataset, window: TimeWindow) -> DataFrame:
    """Rows of a time window."""
    return rows.where(window.holds(timed(spec)))


def ensure_tables(spark: SparkSession, base: str, datasets: tuple[Dataset, ...] = DATASETS) -> list[str]:
    """Makes an empty bronze table of every dataset that has none; the names of those made."""
    made = []
    for spec in datasets:
        path = layer_path(base, "bronze", spec.table)
        if not _there(spark, path):
            spark.createDataFrame([], StructType(spec.stored.fields).add(PART, StringType())).write.partitionBy(PART).parquet(path)
            made.append(spec.table)
    return made


def exists(spark: SparkSession, base: str, layer: str, name: str) -> bool:
    return _there(spark, layer_path(base, layer, name))


def stored(spark: SparkSession, base: str, layer: str, name: str) -> DataFrame:
    """A built table; columns that split it are texts."""
    if not exists(spark, base, layer, name):
        raise MissingTable(f"{layer} table {name} has not been built under {base}")
    return spark.read.option("partitionColumnTypeInference", "false").parquet(layer_path(base, layer, name))


def seen(observation: Observation) -> dict:
    """What an observation saw. Without any row Spark may leave its part of the plan out: then it saw nothing."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}


def drop_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder of any file system that Spark reads, if it is there."""
    system, at = _at(spark, path)
    system.delete(at, True)


def gold(spark: SparkSession, base: str, name: str) -> DataFrame:
    return stored(spark, base, "gold", name)


def write_full(df: DataFrame, base: str, layer: str, name: str) -> None:
    """Full rebuild of one silver or gold table."""
    df.write.mode("overwrite").parquet(layer_path(base, layer, name))
