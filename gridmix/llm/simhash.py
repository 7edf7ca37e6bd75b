"""SimHash near-duplicates with generalised pigeonhole search.

Fingerprints are 64-bit majorities over 3-word shingles. Two fingerprints link if they differ in ``MOST`` bits or
fewer. Equal fingerprints are one row from here on. Correlated bits are grouped into partitions; partition i gets a
threshold t_i (-1: not probed) with sum(t_i + 1) = MOST + 1, so two linked fingerprints differ by t_i or fewer bits in
some partition i. The thresholds minimise the estimated number of candidates, by dynamic programming. Candidates that
meet under a key are verified by all 64 bits. Under one key, links are followed from unvisited to unvisited rows, so a
key with n rows gives fewer than n edges, and a key with very many rows is first split by further bits, exactly.

Defined results: null and empty texts have fingerprint zero and are linked like any other; texts of one or two words
have one shingle; repeated rows share a component; a null doc_id is never a component's id (a component of such rows
only has none); an empty table gives an empty result; only doc_id and text of the input are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.llm.common import by_batch, components, hashed_share, staged, table

WORDS, SEED, BITS, MOST = 3, 42, 64, 3
#: About how many fingerprints the numbers of candidates are estimated on; results don't depend on it.
SAMPLE_ROWS = 20_000
#: Keys with more rows than this are split by further bits.
HOT = 20_000
#: Keys with no more free bits are not split: no more than 2**FREE fingerprints have one.
FREE = 12
#: Groups up to this size are compared by shifted arrays, larger ones by search from row to row.
SMALL = 48
#: Costs of a row shuffled and of a candidate pair verified, relative to each other.
ROW_COST, PAIR_COST = 1.0, 0.01
ONE = np.uint64(1)


def fingerprint(text: bytes, k: int = WORDS) -> int:
    import xxhash

    w = text.lower().split()  # of bytes: A-Z and the six ASCII spaces only
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(k)))) if len(w) >= k else [b" ".join(w)]
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), grams), np.uint64)
    ones = np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """fp (signed long) added to all columns of the input but text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = batch["text"].cast(pa.binary()).to_pylist()
        fp = pa.array([fingerprint(t) if t else 0 for t in text], pa.int64())
        return batch.drop_columns(["text"]).append_column("fp", fp)

    kept = docs.drop("text").schema
    return by_batch(docs, run, type(kept)([*kept.fields]).add("fp", "long"))


def bit_sums(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each pair of bits, in how many both are set: each task sends 64 x 64 sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            fp = batch["fp"].to_numpy().view(np.uint64)
            x = np.unpackbits(fp.view(np.uint8), bitorder="little").reshape(-1, BITS).astype(np.float32)
            total += x.T @ x
            n += len(fp)
        at = np.arange(BITS * BITS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(total.reshape(-1), n))], ["at", "s"])

    out = np.zeros(BITS * BITS + 1)
    for at, s in distinct.select("fp").mapInArrow(run, "at long, s double").groupBy("at").agg(F.sum("s")).collect():
        out[at] = s
    return int(out[-1]), out[:-1].reshape(BITS, BITS)


def grouped_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of nearly equal width, each grown from a free bit by the free bits most correlated with it."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    free, out = set(range(BITS)), []
    for i in range(m):
        width = (BITS - sum(map(len, out))) // (m - i)
        own = [min(free, key=lambda b: (sd[b], b))]
        free -= {own[0]}
        while len(own) < width:
            nearest = max(free, key=lambda b: (corr[b, own].mean(), -b))
            own.append(nearest)
            free.discard(nearest)
        out.append(sorted(own))
    return out


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def estimated_pairs(sample: np.ndarray, n: int, bits: list[int]) -> list[float]:
    """Estimated pairs of n fingerprints that agree in these bits, and that differ there in one bit at most."""
    scale = (n / max(len(sample), 1)) ** 2
    keys = sample & np.uint64(mask_of(bits))
    pairs = lambda k: float((c := np.unique(k, return_counts=True)[1].astype(float)) @ (c - 1)) / 2
    near = sum(pairs(keys & ~(ONE << np.uint64(b))) for b in bits)
    return [pairs(keys) * scale, near * scale]


def plan(sample: np.ndarray, n: int, both: np.ndarray, most: int = MOST) -> list[tuple[list[int], int]]:
    """Partitions and their thresholds. For each number of partitions a table over (partitions, budget) gives the
    cheapest thresholds that add up to most + 1; the cheapest number of partitions wins."""
    best: tuple[float, list] = (float("inf"), [])
    for m in range(2, most + 4):
        parts = grouped_bits(n, both, m)
        costs = []
        for bits in parts:
            exact, near = estimated_pairs(sample, n, bits)
            costs.append([0.0, ROW_COST * n + PAIR_COST * exact, ROW_COST * n * len(bits) + PAIR_COST * near])
        table = {0: (0.0, [])}
        for c in costs:
            step: dict[int, tuple[float, list]] = {}
            for spent, (cost, ts) in table.items():
                for t in (-1, 0, 1):
                    to = min(spent + t + 1, most + 1)
                    if to not in step or cost + c[t + 1] < step[to][0]:
                        step[to] = (cost + c[t + 1], [*ts, t])
            table = step
        if most + 1 in table and table[most + 1][0] < best[0]:
            best = (table[most + 1][0], [(b, t) for b, t in zip(parts, table[most + 1][1]) if t >= 0])
    return best[1]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def masks_of(parts: list[tuple[list[int], int]]) -> list[int]:
    """The bits that keys keep: a partition's for threshold 0; for threshold 1 those less one, for each one."""
    return [mask_of(bits) & ~(1 << drop if t else 0) for bits, t in parts for drop in (bits if t else [0])]


def keys_of(fp: Column, masks: list[int]) -> Column:
    """Array of (mask, key) of a fingerprint."""
    return F.array(*[F.struct(F.lit(signed(m)).alias("mask"), fp.bitwiseAND(F.lit(signed(m)).cast("long")).alias("key")) for m in masks])


def refined(rows: DataFrame, hot: int, most: int = MOST) -> DataFrame:
    """(key, fp): keys that more than ``hot`` rows hold become most + 1 finer keys each, with the free bits in most + 1
    pieces, of which linked fingerprints share one; and again, until no key is hot or at most FREE bits are free."""
    out = []
    while True:
        crowded = rows.where(F.bit_count("mask") < BITS - FREE).groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).drop("n")
        crowded = staged(crowded)
        if crowded.isEmpty():
            return reduce(DataFrame.unionByName, [*out, rows]).select(F.xxhash64("mask", "key").alias("key"), "fp")
        out.append(rows.join(crowded, ["mask", "key"], "left_anti"))
        masks = [r["mask"] % (1 << BITS) for r in crowded.select("mask").distinct().collect()]  # one row a mask
        finer = {m: [m | mask_of([b for b in range(BITS) if not m >> b & 1][j :: most + 1]) for j in range(most + 1)] for m in masks}
        known = rows.sparkSession.createDataFrame([(signed(m), list(map(signed, own))) for m, own in finer.items()], "mask long, finer array<long>")
        again = rows.join(crowded, ["mask", "key"], "left_semi").join(F.broadcast(known), "mask").select(F.explode("finer").alias("mask"), "fp")
        rows = staged(again.select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("key"), "fp"))


def labels_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node reached by each of n nodes over undirected edges."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def links(key: np.ndarray, fp: np.ndarray, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, representative) for rows sorted by key: linked rows under a key get one representative."""
    n = len(key)
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(start, n))
    end = np.repeat(start + size, size)
    small = np.repeat(size <= SMALL, size)
    ea, eb = [], []
    for d in range(1, int(size[size <= SMALL].max(initial=1))):
        i = np.flatnonzero(small[: n - d] & (np.arange(n - d) + d < end[: n - d]))
        i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= most]
        ea.append(i)
        eb.append(i + d)
    for s, c in zip(start[size > SMALL], size[size > SMALL]):
        # From each visited row to the rows not visited yet: every row is visited once and leaves the search at once.
        left = np.arange(s, s + c)
        while len(left):
            todo, left = [left[0]], left[1:]
            while todo and len(left):
                at = todo.pop()
                near = np.bitwise_count(fp[left] ^ fp[at]) <= most
                if near.any():
                    found = left[near]
                    left = left[~near]
                    todo += found.tolist()
                    ea.append(np.full(len(found), at))
                    eb.append(found)
    if not ea:
        return fp[:0], fp[:0]
    label = labels_of(n, np.concatenate(ea), np.concatenate(eb))
    own = np.flatnonzero(label != np.arange(n))
    return fp[own], fp[label[own]]


def verified(keyed: DataFrame) -> DataFrame:
    """Edges (a, b) between fingerprints that share a key and link. Rows of a key come sorted, batch after batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def edges(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            a, b = links(k, f)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            key = np.concatenate([key, batch["key"].to_numpy()])
            fp = np.concatenate([fp, batch["fp"].to_numpy().view(np.uint64)])
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
            if cut:
                yield edges(key[:cut], fp[:cut])
                key, fp = key[cut:], fp[cut:]
        if len(key):
            yield edges(key, fp)

    return keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(run, "a long, b long")


def edges_of(distinct: DataFrame, hot: int = HOT) -> DataFrame:
    """Links (a, b) between different fingerprints that lead from each one to all it can reach."""
    n, both = bit_sums(distinct)
    sample = np.array([r["fp"] for r in hashed_share(distinct, n, SAMPLE_ROWS, "fp").select("fp").collect()], np.int64).view(np.uint64)
    parts = plan(sample, n, both)
    masks = masks_of(parts)
    keyed = distinct.select("fp", F.explode(keys_of(F.col("fp"), masks)).alias("k")).select("k.mask", "k.key", "fp")
    return verified(refined(keyed, hot))


def components_of(distinct: DataFrame, hot: int = HOT) -> DataFrame:
    """(fp, root) for all fingerprints that link to another one."""
    return components(edges_of(distinct, hot)).select(F.col("node").alias("fp"), "root")


def with_components(rows: DataFrame, order: list[str], hot: int = HOT) -> DataFrame:
    """Adds ``least`` to rows with a column fp: the least struct of ``order`` in the row's component."""
    first = F.min(F.struct(*order))
    distinct = staged(rows.groupBy("fp").agg(first.alias("own")))
    linked = components_of(distinct, hot)
    known = distinct.join(linked, "fp", "left").select("fp", "own", F.coalesce("root", "fp").alias("root"))
    least = known.groupBy("root").agg(F.min("own").alias("least"))
    return rows.join(known.join(least, "root").select("fp", "least"), "fp")


def near_duplicates(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, fingerprint and component_id of every row."""
    rows = staged(fingerprints(docs.select("doc_id", "text")))
    # Rows without an id come last in the order, so they name a component only if it has no other rows.
    ordered = rows.withColumn("no_id", F.col("doc_id").isNull())
    found = with_components(ordered, ["no_id", "doc_id"], hot)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least.doc_id").alias("component_id"))


def keep_one(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """One row of each component stays, that with the least doc_id; all columns are kept."""
    name = next(n for n in (f"_row{i}" for i in range(len(docs.columns) + 1)) if n not in map(str.lower, docs.columns))
    numbered = staged(docs.withColumn(name, F.monotonically_increasing_id()))  # read twice: the numbers are stored
    rows = staged(fingerprints(numbered.select("doc_id", "text", F.col(name).alias("_row"))).withColumn("no_id", F.col("doc_id").isNull()))
    found = with_components(rows, ["no_id", "doc_id", "_row"], hot)
    stay = found.where(F.col("_row") == F.col("least._row")).select(F.col("_row").alias(name))
    return numbered.join(stay, name, "left_semi").drop(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
