"""Best-two-fit packing of token sequences.

Lengths are 1 to ``SIZE``, so the packing is decided on the histogram of lengths: one bin pattern is made at a time
and repeated as often as its lengths last. A pattern is filled greedily (largest length first, then the largest that
fits), then its smallest piece is replaced by the two unpacked pieces that fill the widened gap most tightly, as long
as that gains. The driver holds SIZE counts and the patterns, whatever the number of documents; pieces find their
place by their rank among the pieces of their length, which tasks count for themselves.

Defined results: null and empty texts are one piece of the end token alone; only documents longer than a sequence are
cut, the first piece taking the remainder; repeated rows are packed as often as they occur; an empty table gives an
empty result; only doc_id and text are read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridmix.llm.bpe import SPLIT, byte_names
from gridmix.llm.common import staged, table

SIZE, END_ID = 1024, 2
VOCABULARY = "byte_bpe_50k.json"
_encoders: dict[str, object] = {}


class Encoder:
    """Token ids of a text as the tokenizers library gives them for a byte-level BPE file.

    Texts of Latin script go through tiktoken with the same vocabulary and pattern (several times faster); all others
    through the tokenizers library itself, as the two may know different versions of Unicode.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {c: b for b, c in enumerate(byte_names())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("same", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
        self.path, self.full = path, None
        self.rare = re.compile("[^\x00-ſ‐-…€]").search

    def __call__(self, text: str) -> np.ndarray:
        if not self.rare(text):
            return np.frombuffer(self.fast.encode_to_numpy(text, allowed_special="all"), np.uint32)
        if self.full is None:  # takes more memory than all else here, and many corpora never need it
            import os

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self.full = Tokenizer.from_file(self.path)
        return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids."""
    if n <= size:
        return [(0, n)]
    first = n % size
    return ([(0, first)] if first else []) + [(a, size) for a in range(first, n, size)]


def pieces(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; and task and place, its rank among those of its length
    in this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task = encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        tail = np.array([end_id], "<u4")
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            out: list[list] = [[] for _ in range(6)]
            for doc_id, text in zip(ids, batch["text"].to_pylist()):
                tokens = np.concatenate([enc(text), tail]) if text else tail
                for k, (a, n) in enumerate(cut(len(tokens), size)):
                    crc = zlib.crc32(tokens[a : a + n].astype("<u4").tobytes())
                    for c, v in zip(out, (doc_id, k, a, n, crc, int(seen[n]))):
                        c.append(v)
                    seen[n] += 1
            kinds = (batch["doc_id"].type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([*map(pa.array, out, kinds), pa.array([task] * len(out[0]), pa.int32())], ["doc_id", "piece", "start", "length", "ids_crc32", "place", "task"])

    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, place long, task int")


def tightest_pair(counts: np.ndarray, low: int, high: int) -> tuple[int, int] | None:
    """Two available lengths whose sum is the largest in (low, high]; of equal sums the one with the largest member."""
    have = np.flatnonzero(counts[: high + 1])
    if not len(have):
        return None
    at = np.searchsorted(have, high - have, side="right") - 1  # the largest partner of each length
    ok = at >= 0
    a, b = have[ok], have[at[ok]]
    lone = (a == b) & (counts[a] < 2)
    if lone.any():  # no second piece of that length: the next smaller partner
        c = at[ok][lone] - 1
        b = b.copy()
        b[lone] = np.where(c >= 0, have[np.maximum(c, 0)], -high)
    total = a + b
    best = int(np.lexsort((np.maximum(a, b), total))[-1]) if len(total) else -1
    if best < 0 or total[best] <= low:
        return None
    return int(max(a[best], b[best])), int(min(a[best], b[best]))


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, list[int]]]:
    """(times, lengths in a bin) by best-two-fit over a histogram of lengths."""
    counts = np.zeros(size + 1, np.int64)
    for n, c in histogram.items():
        counts[n] = c
    out = []
    while counts.any():
        left, own, gap = counts.copy(), [], size
        while gap and len(fit := np.flatnonzero(left[1 : gap + 1])):
            n = int(fit[-1]) + 1
            own.append(n)
            left[n] -= 1
            gap -= n
        while gap and len(own) > 1:
            least = min(own)
            pair = tightest_pair(left, least, least + gap)
            if pair is None:
                break
            own.remove(least)
            left[least] += 1
            own += pair
            for n in pair:
                left[n] -= 1
            gap -= sum(pair) - least
        n, used = np.unique(own, return_counts=True)
        times = int((counts[n] // used).min())
        counts[n] -= times * used
        out.append((times, own))
    return out


class Slots:
    """Places of all patterns by length: the r-th piece of a length goes to the slot that covers rank r."""

    def __init__(self, made: list[tuple[int, list[int]]]):
        rows: dict[int, list[list[int]]] = {}
        first = 0
        for times, own in made:
            offset = 0
            for n in own:
                slots = rows.setdefault(n, [[0], [], []])
                slots[0].append(slots[0][-1] + times)
                slots[1].append(first)
                slots[2].append(offset)
                offset += n
            first += times
        self.by = {n: tuple(map(np.array, x)) for n, x in rows.items()}

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """sequence_id and offset for each (length, rank)."""
        seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for n in np.unique(length):
            own = length == n
            start, first, offset = self.by[int(n)]
            at = np.searchsorted(start, rank[own], side="right") - 1
            seq[own], off[own] = first[at] + rank[own] - start[at], offset[at]
        return seq, off


def pack(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with the sequence each is in and its offset there."""
    cutted = staged(pieces(docs, path, size, end_id))
    by_task = cutted.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in cutted.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most SIZE rows
    slots = Slots(patterns(histogram, size))
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    first = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = cutted.join(first, ["task", "length"]).withColumn("place", F.col("place") + F.col("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq, off = slots.find(batch["length"].to_numpy(), batch["place"].to_numpy())
            yield batch.drop_columns(["place"]).append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(off))

    use = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "place")
    kind = use.drop("place").schema
    return use.mapInArrow(run, type(kind)([*kind.fields]).add("sequence_id", "long").add("offset", "long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
