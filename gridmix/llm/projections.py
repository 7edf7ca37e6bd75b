"""Near-duplicate embeddings by collision-counting projections.

Vectors link at a cosine of ``COSINE`` or more. Equal vectors are one node from here on. There are many lists; in each,
nodes are sorted by a one-dimensional random projection, under the signs of some further ones, so that a window doesn't
hold a fixed share of the table. Each node is a query once a list: nodes of the same signs whose projections lie in a
window of ``REACH`` around its own collide with it. For a pair at the threshold the chance of a collision is known, so
the number of lists is such that it collides ``COUNT`` times or more with a chance of ``RECALL``; nearer pairs do so more
surely. Pairs with that many collisions are verified by their cosine in double precision.

Large groups of copies don't give all their pairs. Nodes within half the angle of a link of one node, the leader, all
link with each other: they are a ball, and pairs inside it are neither counted nor verified. Leaders are chosen from
crowded signs (``CROWD`` nodes or more) of the first lists: each node takes the least leader that any node with the same
signs has, if it is near enough, and again. Signs with nodes of one ball only give nothing. Signs with more than ``HOT``
nodes are dealt out by pairs of blocks of about that size; two blocks of the most frequent ball are no such pair.

Defined results: vectors that are null, empty, zero or have null or non-finite components link with nothing and are
components of their own; so do vectors of different lengths with each other; repeated rows link; a row without vec_id is
a row like any other and never names a component unless it has no other rows; an empty table gives an empty result;
only vec_id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, comb, erf, log2, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.llm.common import components, small_batches, staged, table

COSINE, RECALL, COUNT = 0.9, 0.99, 2
#: Half a window, for projections of unit vectors on Gaussian directions.
REACH = 0.8
#: Cosine to a leader of members of a ball: a little over that of half the angle of a link.
NEAR = 0.975
#: Lists that leaders are chosen from, and times that leaders are passed on.
FIRST, ROUNDS = 8, 3
CROWD, HOT = 16, 2000
#: Lines that a task gathers before it forms pairs, and pairs in windows at once, about.
LINES, PLACES = 100_000, 1 << 20


def usable(batch: pa.RecordBatch) -> np.ndarray:
    """Which rows have a vector that can link."""
    column = batch["v"]
    size = np.diff(column.offsets.to_numpy())
    row = np.repeat(np.arange(len(size)), size)
    c = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    finite = np.bincount(row, ~np.isfinite(c), len(size)) == 0
    return finite & (np.bincount(row, np.nan_to_num(c) != 0, len(size)) > 0)


def units(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors) of each length of vectors."""
    size = np.diff(column.offsets.to_numpy())
    c = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    out = []
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        x = c[np.repeat(size == d, size)].reshape(-1, d)
        x = x / np.abs(x).max(1, keepdims=True)  # no overflow of squares
        out.append((at, x / np.sqrt((x * x).sum(1, keepdims=True))))
    return out


def chance(signs: int, cosine: float = COSINE) -> float:
    """That two unit vectors at this cosine collide in a list."""
    return (1 - acos(cosine) / pi) ** signs * erf(REACH / sqrt(4 - 4 * cosine))  # projections differ by N(0, 2 - 2 cosine)


def lists_for(signs: int, recall: float = RECALL, count: int = COUNT) -> int:
    """The least number of lists in which a pair at the threshold collides ``count`` times with this chance."""
    p, n = chance(signs), count
    while sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(count)) > 1 - recall:
        n += 1
    return n


def signs_for(n: int) -> int:
    """Signs so that an even table has few nodes under each: candidates stay in proportion to nodes and lists."""
    return max(2, min(30, round(log2(max(n, 1))) - 2))


def directions(d: int, number: int) -> np.ndarray:
    return np.random.default_rng(d).normal(size=(d, number))


def keys_of(nodes: DataFrame, signs: int, lists: int) -> DataFrame:
    """node, ball, key (list, length of the vector and signs) and p, the projection, of every node and list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: dict[int, np.ndarray] = {}
        for batch in batches:
            for rows, x in units(batch["v"]):
                d = x.shape[1]
                if d not in given:
                    given[d] = directions(d, lists * (signs + 1))
                for at in range(0, len(rows), 1000):
                    own = x[at : at + 1000]
                    y = (own @ given[d]).reshape(len(own), lists, signs + 1)
                    bits = (y[:, :, :signs] > 0) @ (1 << np.arange(signs, dtype=np.int64))
                    key = ((np.arange(lists, dtype=np.int64) * 4096 + d % 4096) << np.int64(signs)) + bits
                    node, ball = (np.repeat(batch[c].to_numpy()[rows[at : at + 1000]], lists) for c in ("node", "ball"))
                    p = y[:, :, signs].reshape(-1).astype(np.float32)
                    yield pa.RecordBatch.from_arrays([*map(pa.array, (node, ball, key.reshape(-1), p))], ["node", "ball", "key", "p"])

    return nodes.select("node", "ball", "v").mapInArrow(run, "node long, ball long, key long, p float")


def cosines(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) at a cosine of ``least`` or more, in double precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.zeros(batch.num_rows, bool)
            x, y = ({d: (rows, u) for rows, u in units(batch[c]) for d in [u.shape[1]]} for c in ("x", "y"))
            for d in x.keys() & y.keys():
                at = np.intersect1d(x[d][0], y[d][0])
                near[at] = np.einsum("ij,ij->i", x[d][1][np.searchsorted(x[d][0], at)], y[d][1][np.searchsorted(y[d][0], at)]) >= least
            yield batch.select(["a", "b"]).filter(pa.array(near))

    x, y = (nodes.select(F.col("node").alias(k), F.col("v").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def balls(nodes: DataFrame, keyed: DataFrame) -> DataFrame:
    """node and leader of the nodes under crowded signs; their own leaders, if no other is near enough."""
    crowded = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= CROWD).select("key")
    keyed = staged(keyed.join(crowded, "key").select("node", "key"))
    now = keyed.select("node").distinct().withColumn("leader", F.col("node"))
    for _ in range(ROUNDS):
        led = keyed.join(now, "node")
        least = led.groupBy("key").agg(F.min("leader").alias("b"))
        asked = staged(led.join(least, "key").where("b < leader").select(F.col("node").alias("a"), "b").distinct())
        better = cosines(asked, nodes, NEAR).groupBy("a").agg(F.min("b").alias("b"))
        now = staged(now.join(better.withColumnRenamed("a", "node"), "node", "left").select("node", F.coalesce("b", "leader").alias("leader")))
    return now


def dealt(keyed: DataFrame, hot: int = HOT) -> DataFrame:
    """Lines of the keys with several balls, with a block and a share, which stands for two blocks, or one alone. A key with up to ``hot`` lines has one block. Otherwise the lines of its most frequent ball have blocks of their own,
    which meet those of the others only."""
    by_ball = keyed.groupBy("key", "ball").agg(F.count(F.lit(1)).alias("c"))
    of_key = by_ball.groupBy("key").agg(F.sum("c").alias("n"), F.max(F.struct("c", "ball")).alias("most"), F.count(F.lit(1)).alias("balls"))
    mixed = of_key.where("balls > 1").select("key", (F.col("n") <= hot).alias("small"), F.col("most.ball").alias("main"), F.ceil(F.col("most.c") / hot).alias("m"), F.ceil((F.col("n") - F.col("most.c")) / hot).alias("o"))
    main, dealt_to = F.col("ball") == F.col("main"), lambda blocks: F.pmod(F.xxhash64("node"), F.col(blocks))
    lines = keyed.join(mixed, "key")
    lines = lines.withColumn("block", F.when(F.col("small"), 0).when(main, dealt_to("m")).otherwise(F.col("m") + dealt_to("o")))
    other = F.when(F.col("small"), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.when(main, F.col("m")).otherwise(0), F.col("m") + F.col("o") - 1))
    lines = lines.withColumn("other", F.explode(other))
    share = F.least("block", "other") * (F.col("m") + F.col("o")) + F.greatest("block", "other")
    return lines.select("key", share.alias("share"), "p", "node", "ball", "block")


def collisions(lines: DataFrame) -> DataFrame:
    """(a, b) for every list in which two nodes of different balls are in each other's windows."""
    names = ["key", "share", "p", "node", "ball", "block"]

    def pairs(key, share, p, node, ball, block) -> Iterator[pa.RecordBatch]:
        change = np.append(True, (key[1:] != key[:-1]) | (share[1:] != share[:-1]))
        start = np.flatnonzero(change)
        group = np.cumsum(change) - 1
        one_block = (np.minimum.reduceat(block, start) == np.maximum.reduceat(block, start))[group]
        # Groups are set apart from each other, so that one search finds the ends of all windows.
        low = p[start][group]
        place = (p - low).astype(float) + group * (float((p - low).max()) + 4 * REACH)
        size = np.searchsorted(place, place + REACH, side="right") - np.arange(len(key)) - 1
        cut = np.append(np.flatnonzero(np.append(True, np.diff(np.cumsum(size) // PLACES) > 0)), len(key))
        for i, j in zip(cut[:-1], cut[1:]):
            one = np.repeat(np.arange(i, j), size[i:j])
            other = one + 1 + np.arange(len(one)) - np.repeat(np.cumsum(size[i:j]) - size[i:j], size[i:j])
            keep = (ball[one] != ball[other]) & (one_block[one] | (block[one] != block[other]))
            a, b = node[one][keep], node[other][keep]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append([batch[c].to_numpy() for c in names])
            count += batch.num_rows
            if count >= LINES:
                own = [np.concatenate(x) for x in zip(*held)]
                cut = int(np.argmax((own[0] == own[0][-1]) & (own[1] == own[1][-1])))  # the last group may go on
                if cut:
                    yield from pairs(*(x[:cut] for x in own))
                held, count = [[x[cut:] for x in own]], len(own[0]) - cut
        if count:
            yield from pairs(*(np.concatenate(x) for x in zip(*held)))

    return lines.select(*names).repartition("key", "share").sortWithinPartitions("key", "share", "p").mapInArrow(run, "a long, b long")


def links_of(nodes: DataFrame, n: int, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(node, ball) of every node, and the links (a, b) between nodes of different balls."""
    signs = signs_for(n)
    alone = nodes.withColumn("ball", F.col("node"))
    led = balls(nodes, keys_of(alone, signs, FIRST))
    nodes = staged(nodes.join(led, "node", "left").select("node", F.coalesce("leader", "node").alias("ball"), "v"))
    keyed = staged(keys_of(nodes, signs, lists_for(signs)))
    counted = collisions(dealt(keyed, hot)).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= COUNT).select("a", "b")
    return nodes.select("node", "ball"), staged(cosines(counted, nodes, COSINE))


def near_duplicates(embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding", hot: int = HOT) -> DataFrame:
    """The id, n_links, component_id and kept of every row."""

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("good", pa.array(usable(batch)))

    kind = embeddings.schema[vector].dataType.simpleString()
    id_kind = embeddings.schema[id_column].dataType.simpleString()
    rows = embeddings.select(F.col(id_column).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(vector).alias("v"))
    rows = staged(rows.mapInArrow(good, f"id {id_kind}, row long, v {kind}, good boolean"))
    named = rows.where("good").withColumn("h", F.xxhash64("v"))
    own = staged(named.groupBy("h", "v").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("weight"), F.min("id").alias("least")))
    nodes = own.select("node", "v")
    known, links = links_of(nodes, own.count(), hot)
    sizes = own.select("node", "weight", "least")
    weights = sizes.select("node", "weight")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    across = both.join(weights.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("weight").alias("across"))
    members = known.join(weights, "node")
    inside = members.groupBy("ball").agg(F.sum("weight").alias("inside"))
    group = components(links.unionByName(known.where("ball <> node").select(F.col("node").alias("a"), F.col("ball").alias("b"))))
    group = known.join(group, "node", "left").select("node", "ball", F.coalesce("root", "node").alias("root"))
    least = group.join(sizes, "node").groupBy("root").agg(F.min("least").alias("component_id"))
    counted = group.join(least, "root").join(inside, "ball").join(across, "node", "left")
    counted = counted.select("node", "component_id", (F.col("inside") - 1 + F.coalesce("across", F.lit(0))).alias("n_links"))
    found = own.select("h", "v", "node").join(counted, "node").select("h", "v", "n_links", "component_id")
    out = named.join(found, ["h", "v"]).select("id", "n_links", "component_id")
    alone = rows.where("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = out.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
    return out.withColumnRenamed("id", id_column)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(small_batches(spark), sf_dir, "embeddings"))


#: Every pair is compared, so this is for small tables.
SQL = f"""
WITH RECURSIVE rows AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
good AS (
  SELECT * FROM rows WHERE len(v) > 0 AND len(list_filter(v, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(v, lambda c: c <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= {COSINE}),
reached AS (SELECT vec_id AS a, vec_id AS b FROM rows UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT r.a AS vec_id, (SELECT count(*) FROM links l WHERE l.a = r.a) AS n_links, min(r.b) AS component_id, r.a = min(r.b) AS kept
FROM reached r GROUP BY r.a
"""
