"""Token counts of whole texts by byte-pair merging (see bpe.py), one Arrow batch at a time and without a shuffle.

Defined results: null and empty texts have no bytes and no tokens; a pre-token of any length costs n log n; repeated
rows give repeated results; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from gridmix.llm.bpe import MergeCounter
from gridmix.llm.common import by_batch, table

LIMIT = 512
VOCABULARY = "byte_bpe_50k.json"
_counters: dict[str, MergeCounter] = {}


def counter(path: str) -> MergeCounter:
    """The counter of this worker process for a vocabulary file."""
    if path not in _counters:
        _counters[path] = MergeCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every text; ``path`` is a vocabulary file that every executor has."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        m, text = counter(path), batch["text"]
        n = pa.array([m.count(t) for t in text.to_pylist()], pa.int64())
        size = pc.cast(pc.fill_null(pc.binary_length(text), 0), pa.int64())
        return pa.RecordBatch.from_arrays([batch["doc_id"], size, n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    docs = docs.select("doc_id", "text")
    return by_batch(docs, count, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
