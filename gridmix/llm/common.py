"""What several operators share: tables of a data folder, staging of intermediate tables, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words in all operators, for Java and RE2 regular expressions.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


#: Rows of an Arrow batch at most. Texts are long: Spark's 10,000 rows would be tens of MB in each of several buffers.
ARROW_ROWS = 1000


def small_batches(spark: SparkSession) -> SparkSession:
    """Sets the session's Arrow batches to ARROW_ROWS rows unless they are smaller already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the session's ``spark.checkpoint.dir``. Without that setting, only a session in one process
    may use a folder under /tmp: executors elsewhere would each write to a disk of their own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file:///tmp/gridmix-shared"
    return f"{base.rstrip('/')}/gridmix-{uuid.uuid4().hex}"


def staged(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Writes a table to the shared folder and reads it back: lineage ends there and nothing is computed twice."""
    spark = df.sparkSession
    path = shared_dir(spark)
    (df.select(*columns) if columns else df).write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.select(*columns).schema if columns else df.schema).parquet(path)
    out.staged_at = path
    for paths in _scratch[-1:]:
        paths.append(path)
    return out


#: Folders staged within open ``scratch`` blocks.
_scratch: list[list[str]] = []


def discard(*frames: DataFrame) -> None:
    """Removes the folders of staged tables that nothing reads any more."""
    for df in frames:
        _remove(df.sparkSession, df.staged_at)


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Tables staged in the block are removed at its end, but for those put into the list it gives. What leaves the
    block must be computed from these alone."""
    kept: list[DataFrame] = []
    _scratch.append([])
    try:
        yield kept
    finally:
        for path in set(_scratch.pop()) - {df.staged_at for df in kept}:
            _remove(spark, path)


def hashed_share(df: DataFrame, n: int, most: int, *columns: str) -> DataFrame:
    """About ``most`` of n rows (fewer, if there are fewer), by a hash of some columns. An ordered limit alone would
    bring that many rows of every partition to one task; after this, one may follow."""
    share = min(1.0, most / max(n, 1))
    return df if share == 1.0 else df.where(F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))


def by_batch(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := f(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> tuple["np.ndarray", "np.ndarray"]:
    """The UTF-8 bytes of a string column as one array, and the offsets of its rows (nulls are empty)."""
    import numpy as np

    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def row_slices(offsets, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``most`` bytes; a longer row stands alone."""
    import numpy as np

    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        yield a, b
        a = b


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star steps: (node, root), root the least node reached.

    ``edges`` has columns a and b of one orderable type. Nodes on no edge are not returned. Every round is written to
    the shared folder, and the one before removed; a sum of hashes of the edges decides when to stop. The least neighbours are stored before they
    are joined, so both sides of the joins are plain shuffles and Spark splits those of a node with very many edges.
    """
    spark = edges.sparkSession
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(rounds):
        # Large star: every larger neighbour is linked to the least of the neighbourhood.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: every smaller neighbour and the node itself are linked to the least.
        large = staged(large.where("a <> b").distinct())
        discard(now, least)
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        now = staged(small.where("a <> b").distinct())
        discard(large, least)
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
    raise RuntimeError(f"components did not settle in {rounds} rounds")
