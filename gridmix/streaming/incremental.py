"""Incremental load of landed files: each micro-batch is upserted by key, however late its rows are.

No watermark: nothing is dropped for being late. In one batch the newest ingested_at_utc wins, then the row with most
measures, then the last to arrive (_seq, as it was landed); between batches the one loaded last. Replays of a batch after a failure change nothing, as the upsert is keyed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gridmix.operators.upsert import LoadResult, upsert
from gridmix.plans.rebuild import refresh
from gridmix.specs import Dataset


def load_landed(spark: SparkSession, base: str, spec: Dataset, landing: str, checkpoint: str, then: Callable[[LoadResult], None] | None = None, order: str = "long") -> StreamingQuery:
    """Loads what has landed since the last run and stops. ``then`` is called with the figures and touched folders of
    each micro-batch, after its upsert and before it counts as done: after a failure both come again. ``order`` is the
    type of _seq in the landed files; files without it have nulls there."""
    rows = spark.readStream.schema(f"{spec.stored.toDDL()}, _seq {order}").parquet(landing)

    def merge(batch: DataFrame, _: int) -> None:
        done = upsert(batch.sparkSession, base, spec, batch)
        if then:
            then(done)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def load_to_gold(spark: SparkSession, base: str, spec: Dataset, landing: str, checkpoint: str, then: Callable[[dict], None] | None = None) -> StreamingQuery:
    """As ``load_landed``; after each micro-batch the silver and gold tables are refreshed for the months it touched.
    ``then`` is called with the tables that were written and their months."""

    def on(done: LoadResult) -> None:
        written = refresh(spark, base, {spec.table: set(done.touched)})
        if then:
            then(written)

    return load_landed(spark, base, spec, landing, checkpoint, on)
