"""Benchmark decontamination: containment of short test items in long documents.

Shingles are five lower-cased (A-Z) words; an item is found in a document if four fifths or more of its distinct
shingles occur there. Items are partitioned by their number of shingles. The MinHash sketch of an item is bottom-k:
its k shingles of least hash, with k = n // 5 + 1 for the largest n of the partition, so a document that holds four
fifths of the item must hold one of the k (only n // 5 may be missing) and the search misses nothing. Documents are
probed whole, by all their shingles; every candidate is verified by exact shingles.

Items are sent to the tasks in blocks of ``BLOCK_BYTES`` of text at most, one pass over the documents per block, so
what is broadcast is bounded whatever the size of the benchmark. Documents are never shuffled.

Defined results: null and empty texts have no shingles and are neither found nor contaminated; a text of one to four
words has one shingle, the whole of it, so a short item is found in documents that equal it; repeated item rows count
once; repeated documents give repeated results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.llm.common import row_slices, table, text_bytes
from gridmix.llm.hashing import BASE, Ranges, mixed

WORDS = 5
#: A block of items, with its shingles, takes about forty times this in a task.
BLOCK_BYTES = 4 << 20
CHUNK = 2 << 20


def word_ranges(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of the rows; words end with their row."""
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    first = np.zeros(len(raw) + 1, bool)
    first[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def shingles(raw: np.ndarray, offsets: np.ndarray, k: int = WORDS, word_hashes=lambda low, start, end: Ranges(low).hash(start, end)) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every shingle, repeats included, of rows given as bytes and offsets."""
    low = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
    start, end = word_ranges(low, offsets)
    row = np.searchsorted(offsets, start, side="right") - 1
    word = word_hashes(low, start, end)
    n = len(word)
    rows, out = [], []
    if n >= k:
        h = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            h = h * BASE + word[j : n - k + 1 + j]
        whole = row[: n - k + 1] == row[k - 1 :]
        rows.append(row[: n - k + 1][whole])
        out.append(mixed(h[whole]))
    at, size = np.unique(row, return_counts=True)
    first = np.cumsum(size) - size
    for r, s, c in zip(at[size < k], first[size < k], size[size < k]):
        h = np.uint64(c)
        for w in word[s : s + c]:
            h = h * BASE + w
        rows.append(np.array([r]))
        out.append(mixed(np.array([h], np.uint64)))
    return (np.concatenate(rows), np.concatenate(out)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def exact_shingles(text: bytes, k: int = WORDS) -> set[bytes]:
    w = text.lower().split()
    return {b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


class Items:
    """The items of a block: their exact shingles, and the items whose sketch holds a hash."""

    def __init__(self, texts: list[bytes]):
        self.sets = [exact_shingles(t) for t in texts]
        raw, offsets = text_bytes(pa.array([t.decode("utf-8", "surrogatepass") for t in texts], pa.string()))
        with np.errstate(over="ignore"):
            row, h = shingles(raw, offsets)
        hashes = [np.unique(h[row == i]) for i in range(len(texts))]
        largest: dict[int, int] = defaultdict(int)  # of each size partition (sizes of one bit length)
        for own in hashes:
            largest[len(own).bit_length()] = max(largest[len(own).bit_length()], len(own))
        by: dict[int, list[int]] = defaultdict(list)
        for i, own in enumerate(hashes):
            for x in own[: largest[len(own).bit_length()] // 5 + 1]:  # in order of hash
                by[int(x)].append(i)
        self.by = dict(by)
        self.keys = np.array(sorted(by), np.uint64)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def candidates(self, h: np.ndarray) -> np.ndarray:
        """Positions of hashes that a sketch holds: a bitmap first, then the sorted keys."""
        at = np.flatnonzero(self.seen[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return at[:0]
        place = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        return at[self.keys[place] == h[at]]


def containments(docs: DataFrame, texts: list[bytes]) -> DataFrame:
    """doc_id, item (its place in texts), n_shared for every document that holds four fifths of an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(texts)
        for batch in batches:
            raw, offsets = text_bytes(batch["text"])
            rows, found, shared = [], [], []
            for a, b in row_slices(offsets, CHUNK):
                part = raw[offsets[a] : offsets[b]]
                with np.errstate(over="ignore"):
                    row, h = shingles(part, offsets[a : b + 1] - offsets[a])
                hit = items.candidates(h)
                pairs = {(int(r), i) for r, x in zip(row[hit], h[hit]) for i in items.by[int(x)]}
                own: dict[int, set[bytes]] = {}
                for r, i in sorted(pairs):
                    if r not in own:
                        own[r] = exact_shingles(raw[offsets[a + r] : offsets[a + r + 1]].tobytes())
                    n = len(items.sets[i] & own[r])
                    if n * 5 >= len(items.sets[i]) * 4:
                        rows.append(a + r)
                        found.append(i)
                        shared.append(n)
            if rows:
                yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(rows)), pa.array(found, pa.int32()), pa.array(shared, pa.int64())], ["doc_id", "item", "n_shared"])

    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item int, n_shared long")


def contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, n_shingles, n_shared, containment for every document and item it holds."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull()).distinct()
    blocks = 1 + (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes
    parts = []
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()  # about block_bytes of text
        texts = [r["text"].encode("utf-8", "surrogatepass") for r in own]
        kind = items.schema["item_id"].dataType.simpleString()
        known = spark.createDataFrame([(i, r["item_id"], len(exact_shingles(t))) for i, (r, t) in enumerate(zip(own, texts))], f"item int, item_id {kind}, n_shingles long")
        parts.append(containments(docs, texts).join(F.broadcast(known), "item").drop("item"))
    found = reduce(DataFrame.unionByName, parts)
    return found.select("doc_id", "item_id", "n_shingles", "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def clean(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, with all columns, that hold no item. Several blocks are filtered one after the other."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull()).distinct()
    blocks = 1 + (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).select("text").distinct().collect()
        texts = [r["text"].encode("utf-8", "surrogatepass") for r in own]
        numbered = docs.mapInArrow(_without(texts), docs.schema)
        docs = numbered
    return docs


def _without(texts: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(texts)
        for batch in batches:
            raw, offsets = text_bytes(batch["text"])
            keep = np.ones(batch.num_rows, bool)
            for a, b in row_slices(offsets, CHUNK):
                with np.errstate(over="ignore"):
                    row, h = shingles(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                hit = items.candidates(h)
                pairs = defaultdict(set)
                for r, x in zip(row[hit], h[hit]):
                    pairs[a + int(r)].update(items.by[int(x)])
                for r, found in pairs.items():
                    own = exact_shingles(raw[offsets[r] : offsets[r + 1]].tobytes())
                    keep[r] = not any(len(items.sets[i] & own) * 5 >= len(items.sets[i]) * 4 for i in found)
            yield batch.filter(pa.array(keep))

    return run


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _grams(name: str, key: str) -> str:
    return f"""
  SELECT DISTINCT {key}, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - {WORDS - 1}), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' ')) END) AS g
  FROM (SELECT {key}, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
        FROM {name})"""


SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents WHERE text IS NOT NULL),
items AS (SELECT row_number() OVER () AS iid, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
i AS ({_grams("items", "iid")}), n AS (SELECT iid, count(*) AS n_shingles FROM i GROUP BY iid),
d AS ({_grams("docs", "rid")}),
m AS (SELECT rid, iid, count(*) AS n_shared FROM d JOIN i USING (g) GROUP BY rid, iid)
SELECT doc_id, item_id, n_shingles::BIGINT AS n_shingles, n_shared::BIGINT AS n_shared, n_shared / n_shingles AS containment
FROM m JOIN n USING (iid) JOIN docs USING (rid) JOIN items USING (iid) WHERE n_shared * 5 >= n_shingles * 4
"""
