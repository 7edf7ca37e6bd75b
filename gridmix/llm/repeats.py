"""Exact removal of long repeats with a run-length index.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts anywhere else. The work is dealt out by
anchors: every window of LENGTH bytes is owned by its k-gram of least hash (the leftmost of equal ones). Equal windows
have equal anchors, and every window has one owner, so all copies of a window meet under one anchor and nowhere else.
The windows that one anchor owns in one place are a stretch of text of at most 2 * LENGTH - K bytes.

Stretches with the same anchor and class hash are one class. An anchor seen once is done: nothing repeats. All others
are decided by an index, from the bytes of each class at one place and, where it occurs again, at a second one: their
suffixes are sorted, the Burrows-Wheeler transform is kept as runs, and for the ends of each run the text position and
the length it shares with its neighbour are sampled. Going through the text, the matching statistic of a position is
the sampled length less the distance from the last sample before it: between samples it falls by one for each byte.
Where it is LENGTH or more, the window starts elsewhere too. Blocks hold whole anchors and are of bounded size. Where
all stretches of an anchor are one class, neighbours that lie side by side at both places are indexed as one text.

An anchor with more than ``MOST_CLASSES`` classes is split: a window that holds a gram of g bytes holds at least half
of the LENGTH - g others on one side of it, so windows are dealt out anew by the gram with that half, and again where
need be until the gram is the window. Every further place of a class is taken to be equal by its hashes (128 bits).

Defined results: null and empty texts have no bytes and nothing to remove; texts shorter than LENGTH are never cut;
repeated rows remove each other; texts of any length are read in overlapping pieces; an empty table gives an empty
result; only doc_id and text are read. The input is read once; its rows are stored with their numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.llm.common import row_slices, staged, table, text_bytes
from gridmix.llm.hashing import MIX, Ranges, mixed

LENGTH, K = 200, 80
#: Bytes hashed at once, and the piece that a longer text is read in.
SLICE = 2 << 20
#: Bytes of stretches that are indexed together (small enough for the processor's cache), and by one task.
BLOCK, TASK = 128 << 10, 8 << 20
#: Classes of one anchor that are indexed together at most.
MOST_CLASSES = 4000
#: Side-by-side stretches are indexed as texts of about so many bytes.
RUN = 16 << 10
PLACE = np.uint64((1 << 24) - 1)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i:i + width]) for every i, by doubling."""
    span = 1
    n = len(x) - width + 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span : width - span + n]) if span < width else x[:n]


def stretches(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, anchor hash, class hash, start, size) of what each anchor owns in rows of bytes; starts count from the row's."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.int64))
    if len(raw) < LENGTH:
        return none
    ranges = Ranges(raw)
    gram = ranges.all_of(K)
    least = sliding_min(gram & ~PLACE | np.arange(len(gram), dtype=np.uint64), LENGTH - K + 1)
    # Windows lie in one row.
    size = np.diff(offsets)
    step = np.zeros(len(raw) + 1, np.int32)
    np.add.at(step, offsets[:-1][size >= LENGTH], 1)
    np.add.at(step, offsets[1:][size >= LENGTH] - LENGTH + 1, -1)
    window = np.flatnonzero(np.cumsum(step[: len(least)]))
    if not len(window):
        return none
    anchor = (least[window] & PLACE).astype(np.int64)
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    last = np.append(first[1:], len(window)) - 1
    a, b = window[first], window[last] + LENGTH
    row = np.searchsorted(offsets, a, side="right") - 1
    return row, gram[anchor[first]].view(np.int64), ranges.hash(a, b).view(np.int64), a - offsets[row], b - a


def row_pieces(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, bytes before, bytes, offsets) of slices; a long row comes in pieces that share LENGTH - 1 bytes."""
    for a, b in row_slices(offsets, SLICE):
        lo, hi = int(offsets[a]), int(offsets[b])
        if b - a > 1 or hi - lo <= 2 * SLICE:
            yield a, 0, raw[lo:hi], offsets[a : b + 1] - lo
            continue
        for at in range(0, hi - lo - LENGTH + 1, SLICE):
            piece = raw[lo + at : min(hi, lo + at + SLICE + LENGTH - 1)]
            yield a, at, piece, np.array([0, len(piece)])


def find_stretches(rows: DataFrame) -> DataFrame:
    """(anchor, class, size, n, row, at, more) with one line for the equal stretches of a slice: the first place in
    row and at, the others (row and at, as big-endian int64, one after the other) in more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch["text"])
            ids = batch["row"].to_numpy()
            for first, before, piece, at in row_pieces(raw, offsets):
                with np.errstate(over="ignore"):
                    row, anchor, kind, start, size = stretches(piece, at)
                if not len(row):
                    continue
                row, start = ids[row + first], start + before
                order = np.lexsort((kind, anchor))
                row, anchor, kind, start, size = (x[order] for x in (row, anchor, kind, start, size))
                head = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (kind[1:] != kind[:-1])))
                n = np.diff(np.append(head, len(row)))
                more: list[bytes | None] = [None] * len(head)
                for i in np.flatnonzero(n > 1):
                    own = slice(head[i] + 1, head[i] + n[i])
                    more[i] = np.stack([row[own], start[own]], 1).astype(">i8").tobytes()
                yield pa.RecordBatch.from_arrays([*(pa.array(x[head]) for x in (anchor, kind, size)), pa.array(n), pa.array(row[head]), pa.array(start[head]), pa.array(more, pa.binary())], ["anchor", "class", "size", "n", "row", "at", "more"])

    return rows.select("row", "text").mapInArrow(run, "anchor long, class long, size long, n long, row long, at long, more binary")


def sorted_suffixes(t: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix array of symbols whose suffixes all differ, by doubling; and the ranks by the first 3, 6, 12... symbols."""
    n, h = len(t), 3
    pad = np.append(t, [0, 0])
    key = pad[:n] << 42 | pad[1 : n + 1] << 21 | pad[2 : n + 2]
    levels = []
    while True:
        sa = np.argsort(key)
        k = key[sa]
        rank = np.empty(n, np.int32)
        rank[sa] = np.cumsum(np.append(True, k[1:] != k[:-1]), dtype=np.int32)
        levels.append((h, rank))
        if rank[sa[-1]] == n:
            return sa, levels
        key = rank.astype(np.int64) << 32
        key[:-h] |= rank[h:]
        h *= 2


def shared_prefix(levels: list[tuple[int, np.ndarray]], t: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of what the suffixes at a and b share: the longest steps first, then symbol by symbol."""
    n, out = len(t), np.zeros(len(a), np.int64)
    top = True
    for h, rank in reversed(levels):
        todo = np.arange(len(a))
        while len(todo):
            x, y = a[todo] + out[todo], b[todo] + out[todo]
            ok = (x < n) & (y < n)
            ok[ok] = rank[x[ok]] == rank[y[ok]]
            todo = todo[ok]
            out[todo] += h
            if not top:
                break
        top = False
    todo = np.arange(len(a))
    while len(todo):
        x, y = a[todo] + out[todo], b[todo] + out[todo]
        ok = (x < n) & (y < n)
        ok[ok] = t[x[ok]] == t[y[ok]]
        todo = todo[ok]
        out[todo] += 1
    return out


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of texts, with samples at both ends of every run.

    ``heads`` and ``tails`` are the text positions at the first and last place of each run of equal symbols;
    ``head_shares`` and ``tail_shares`` the lengths they share with the suffix before and behind in sorted order.
    """

    def __init__(self, texts: list[bytes]):
        parts = []
        for i, x in enumerate(texts):  # each text ends with a symbol of its own, so no match goes past it
            parts += [np.frombuffer(x, np.uint8).astype(np.int64) + 1, np.array([257 + i])]
        self.text = np.concatenate(parts)
        self.starts = np.cumsum([0, *(len(x) + 1 for x in texts)])
        sa, levels = sorted_suffixes(self.text)
        bwt = self.text[sa - 1]
        first = np.flatnonzero(np.append(True, bwt[1:] != bwt[:-1]))
        last = np.append(first[1:], len(bwt)) - 1
        self.symbols, self.lengths = bwt[first], last - first + 1
        self.heads, self.tails = sa[first], sa[last]
        self.head_shares = np.append(0, shared_prefix(levels, self.text, sa[first[1:] - 1], sa[first[1:]]))
        self.tail_shares = np.append(self.head_shares[1:], 0)  # behind the tail of a run comes the head of the next

    def matching_statistics(self) -> np.ndarray:
        """For each text position the length of the longest match that starts elsewhere."""
        at = np.arange(len(self.text))
        out = np.zeros(len(self.text), np.int64)
        for samples, shares in ((self.heads, self.head_shares), (self.tails, self.tail_shares)):
            reach = np.zeros(len(self.text), np.int64)
            here = np.zeros(len(self.text), np.int64)
            reach[samples], here[samples] = shares + samples, samples
            out = np.maximum(out, reach[np.maximum.accumulate(here)] - at)
        return out

    def long_matches(self, least: int) -> Iterator[tuple[int, int, int]]:
        """(text, start, end): maximal stretches of each text covered by matches of ``least`` symbols or more."""
        at = np.flatnonzero(self.matching_statistics() >= least)
        text = np.searchsorted(self.starts, at, side="right") - 1
        a = at - self.starts[text]
        cut = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (a[1:] > a[:-1] + least))) if len(at) else at
        for i, j in zip(cut, np.append(cut[1:], len(at))):
            yield int(text[i]), int(a[i]), int(a[j - 1]) + least


def indexed(texts: DataFrame, tasks: int) -> DataFrame:
    """(anchor, class, a, b): what repeats of each class, from lines (key, anchor, class, copy, members, bytes) with all
    texts of their key. A text with copy 1 is there to be found. ``members`` lists the stretches a text is made of:
    anchor, class, start and size, as int64; without it the text is the stretch of its anchor and class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple] = []  # whole keys
        own: list[tuple] = []  # the key being read
        total = own_total = 0

        def out(rows: list) -> pa.RecordBatch:
            cols: list[list] = [[], [], [], []]
            for i, a, b in RunLengthIndex([r[5] for r in rows]).long_matches(LENGTH):
                _, anchor, kind, copy, members, _ = rows[i]
                if copy:
                    continue
                parts = np.frombuffer(members, np.int64).reshape(-1, 4).tolist() if members else [(anchor, kind, 0, len(rows[i][5]))]
                for part, sub, start, size in parts:
                    x, y = max(a, start), min(b, start + size)
                    if y - x >= LENGTH:
                        for c, v in zip(cols, (part, sub, x - start, y - start)):
                            c.append(v)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["anchor", "class", "a", "b"])

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in TEXT)):
                if own and row[0] != own[0][0]:
                    if block and total + own_total > BLOCK:
                        yield out(block)
                        block, total = [], 0
                    block += own
                    total += own_total
                    own, own_total = [], 0
                own.append(row)
                own_total += len(row[5])
        if block and total + own_total > BLOCK:
            yield out(block)
            block = []
        if block or own:
            yield out(block + own)

    return texts.select(*TEXT).repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(run, "anchor long, class long, a long, b long")


TEXT = ["key", "anchor", "class", "copy", "members", "bytes"]


def cut_out(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Lines of TEXT for wanted lines (row, at, size, key, anchor, class, copy, members)."""
    of_row = wanted.groupBy("row").agg(F.collect_list(F.struct("key", "anchor", "class", "copy", "members", "at", "size")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
        for batch in batches:
            lists, texts = batch["wanted"], batch["text"].cast(pa.binary()).to_pylist()
            flat = lists.flatten()
            again = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            cuts = [texts[i][a : a + n] for i, a, n in zip(again.tolist(), flat.field("at").to_pylist(), flat.field("size").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(flat.field(c).cast(k) for c, k in zip(TEXT[:5], kinds)), pa.array(cuts, pa.binary())], TEXT)

    # All columns of the rows, so that their shuffle serves the join at the end as well.
    return rows.join(of_row, "row").mapInArrow(run, "key long, anchor long, class long, copy int, members binary, bytes binary")


def both_places(classes: DataFrame) -> DataFrame:
    """Wanted lines of classes: their first place, and the second where there is one."""
    first = F.struct("row", "at", F.lit(0).alias("copy"))
    second = F.struct(F.col("row2").alias("row"), F.col("at2").alias("at"), F.lit(1).alias("copy"))
    x = F.explode(F.when(F.col("n") > 1, F.array(first, second)).otherwise(F.array(first))).alias("x")
    return classes.select(F.col("anchor").alias("key"), "anchor", "class", "size", F.lit(None).cast("binary").alias("members"), x).select(
        "key", "anchor", "class", "size", "members", "x.row", "x.at", "x.copy"
    )


def side_by_side(classes: DataFrame) -> DataFrame:
    """Wanted lines of classes that have their anchor to themselves: those whose stretches follow each other at both
    places are one text."""
    of_row = classes.groupBy("row").agg(F.collect_list(F.struct("at", "size", "row2", "at2", "anchor", "class")).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["own"]
            flat = lists.flatten()
            at, size, row2, at2, anchor, kind = (flat.field(c).to_numpy() for c in ("at", "size", "row2", "at2", "anchor", "class"))
            row = np.repeat(batch["row"].to_numpy(), lists.value_lengths().to_numpy())
            if not len(row):
                continue
            order = np.lexsort((at, row))
            row, at, size, row2, at2, anchor, kind = (x[order] for x in (row, at, size, row2, at2, anchor, kind))
            cut = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + size[:-1] - LENGTH + 1) | (row2[1:] != row2[:-1]) | (np.diff(at2 - at) != 0) | (np.diff(at // RUN) != 0)
            head = np.flatnonzero(np.append(True, cut))
            last = np.append(head[1:], len(row)) - 1
            whole = at[last] + size[last] - at[head]
            start = at - np.repeat(at[head], last - head + 1)
            table = np.stack([anchor, kind, start, size], 1)
            members = [table[a : b + 1].tobytes() for a, b in zip(head, last)]
            with np.errstate(over="ignore"):
                key = mixed((row[head].astype(np.uint64) << np.uint64(20)) ^ at[head].astype(np.uint64) * MIX).view(np.int64)
            n = len(head)
            twice = lambda x, y: pa.array(np.concatenate([x, y]))
            yield pa.RecordBatch.from_arrays(
                [twice(key, key), twice(anchor[head], anchor[head]), twice(kind[head], kind[head]), twice(whole, whole), pa.array(members + [None] * n, pa.binary()), twice(row[head], row2[head]), twice(at[head], at2[head]), pa.array([0] * n + [1] * n, pa.int32())],
                ["key", "anchor", "class", "size", "members", "row", "at", "copy"],
            )

    return of_row.mapInArrow(run, "key long, anchor long, class long, size long, members binary, row long, at long, copy int")


def anchor_place(text: bytes) -> int:
    """Where a stretch's anchor is: its k-gram of least hash, the leftmost of equal ones."""
    with np.errstate(over="ignore"):
        gram = Ranges(np.frombuffer(text, np.uint8)).all_of(K)
    return int(np.argmin(gram & ~PLACE | np.arange(len(gram), dtype=np.uint64)))


def halves(text: bytes, place: int, gram: int) -> Iterator[tuple[bytes, int, int, int]]:
    """(longer gram, its place in the part, start of the part, its end): the windows of a text around a gram, dealt out
    to those that hold half of the other bytes behind it and those that hold half before it."""
    rest = LENGTH - gram
    half = -(-rest // 2)
    a, b = max(0, place - (rest - half)), min(place, len(text) - LENGTH)
    if a <= b:
        yield b"+" + text[place : place + gram + half], place - a, a, b + LENGTH
    a, b = max(0, place - rest), min(place - (rest - half) - 1, len(text) - LENGTH)
    if a <= b:
        yield b"-" + text[place - half : place + gram], place - half - a, a, b + LENGTH


def finer(texts: DataFrame, gram: int) -> DataFrame:
    """(key, anchor, class, skipped, place, bytes): lines (anchor, class, skipped, place, bytes) under longer grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for anchor, kind, skipped, place, text in zip(*(batch[c].to_pylist() for c in ("anchor", "class", "skipped", "place", "bytes"))):
                for longer, at, a, b in halves(text, anchor_place(text) if place is None else place, gram):
                    key = int.from_bytes(hashlib.blake2b(longer, digest_size=8).digest(), "big", signed=True)
                    for c, v in zip(cols, (key, anchor, kind, skipped + a, at, text[a:b])):
                        c.append(v)
            kinds = (*[pa.int64()] * 5, pa.binary())
            yield pa.RecordBatch.from_arrays(list(map(pa.array, cols, kinds)), ["key", "anchor", "class", "skipped", "place", "bytes"])

    return texts.mapInArrow(run, "key long, anchor long, class long, skipped long, place long, bytes binary")


def split_crowded(texts: DataFrame, tasks: int, most: int) -> list[DataFrame]:
    """What ``indexed`` gives, of anchors with too many classes. Equal parts under a key are indexed once or, as a
    second copy, twice; once the gram is the window, all parts of a key are equal."""
    gram, out = K, []
    todo = texts.select("anchor", "class", F.lit(0).cast("long").alias("skipped"), F.lit(None).cast("long").alias("place"), "bytes")
    while True:
        level = staged(finer(todo, gram))
        gram += -(-(LENGTH - gram) // 2)
        parts = level.groupBy("key", "bytes").agg(F.count(F.lit(1)).alias("n"))
        parts = staged(parts.withColumn("part", F.monotonically_increasing_id()))
        crowded = staged(parts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("key"))
        own = parts.join(crowded, "key", "left_anti")
        copies = F.explode(F.when(F.col("n") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
        found = indexed(own.select("key", F.col("key").alias("anchor"), F.col("part").alias("class"), copies, F.lit(None).cast("binary").alias("members"), "bytes"), tasks)
        found = found.select(F.col("anchor").alias("key"), F.col("class").alias("part"), "a", "b").join(own, ["key", "part"]).select("key", "bytes", "a", "b")
        out.append(level.join(found, ["key", "bytes"]).select("anchor", "class", (F.col("a") + F.col("skipped")).alias("a"), (F.col("b") + F.col("skipped")).alias("b")))
        if crowded.isEmpty():
            return out
        todo = level.join(crowded, "key", "left_semi").select("anchor", "class", "skipped", "place", "bytes")


def places(found: DataFrame) -> DataFrame:
    """(row, a, b) for lines (row, at, more, a, b): the stretch a..b at every place of the line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            more = [np.frombuffer(x, ">i8").astype(np.int64).reshape(-1, 2) if x else np.zeros((0, 2), np.int64) for x in batch["more"].to_pylist()]
            again = np.repeat(np.arange(batch.num_rows), [len(x) for x in more])
            rest = np.concatenate(more) if more else np.zeros((0, 2), np.int64)
            row = np.concatenate([batch["row"].to_numpy(), rest[:, 0]])
            at = np.concatenate([batch["at"].to_numpy(), rest[:, 1]])
            a, b = (np.concatenate([x, x[again]]) for x in (batch["a"].to_numpy(), batch["b"].to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(at + a), pa.array(at + b)], ["row", "a", "b"])

    return found.select("row", "at", "more", "a", "b").mapInArrow(run, "row long, a long, b long")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by half-open spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def class_table(twice: DataFrame) -> DataFrame:
    """(anchor, class, one, n, row, at, size, row2, at2): every class with how often it occurs, its first place and a second one."""
    number = lambda at: F.conv(F.hex(F.substring("more", at, 8)), 16, 10).cast("long")
    here = F.struct("row", "at")
    other = F.when(F.col("more").isNull(), here).otherwise(F.greatest(here, F.struct(number(1).alias("row"), number(9).alias("at"))))
    n = F.lit(1) + F.coalesce(F.octet_length("more") / 16, F.lit(0)).cast("long")
    made = twice.groupBy("anchor", "class").agg(F.sum(n).alias("n"), F.first("one").alias("one"), F.min(F.struct("row", "at", "size")).alias("p"), F.max(other).alias("q"))
    return made.select("anchor", "class", "one", "n", "p.row", "p.at", "p.size", F.col("q.row").alias("row2"), F.col("q.at").alias("at2"))


def repeats(docs: DataFrame, most_classes: int = MOST_CLASSES) -> DataFrame:
    """doc_id, text and spans (maximal removed runs of bytes, as array<struct<a,b>>) of every row."""
    # Read in several jobs: the numbers of a scan hold only for its splits, so they are stored.
    rows = staged(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row", F.monotonically_increasing_id()))
    lines = find_stretches(rows)
    # Pre-aggregated and stored first: the join then has a plain shuffle on both sides, of which Spark splits hot keys.
    keys = lines.groupBy("anchor").agg(F.sum("n").alias("total"), (F.min("class") == F.max("class")).alias("one"))
    keys = staged(keys.where("total > 1").select("anchor", "one"))
    twice = staged(lines.join(keys, "anchor").select("anchor", "class", "size", "row", "at", "more", "one"))
    classes = staged(class_table(twice))
    several = classes.where("not one")
    # Stretches that lie side by side share LENGTH - 1 bytes: about a third of their bytes are indexed, each at two places.
    tasks = 1 + int(classes.agg(F.sum(F.when(F.col("one"), F.col("size") / 3).otherwise(F.col("size")))).first()[0] or 0) // TASK
    crowded = staged(several.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > most_classes).select("anchor"))
    texts = cut_out(rows, both_places(several.join(crowded, "anchor", "left_anti")).unionByName(side_by_side(classes.where("one"))))
    found = indexed(texts, tasks)
    if not crowded.isEmpty():
        for part in split_crowded(cut_out(rows, both_places(several.join(crowded, "anchor", "left_semi"))), tasks, most_classes):
            found = found.unionByName(part)
    spans = places(twice.select("anchor", "class", "row", "at", "more").join(found, ["anchor", "class"]))
    of_row = spans.groupBy("row").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    # The condition, always true, makes this side the one that cut_out shuffles, so that Spark reuses that shuffle.
    return rows.where(F.col("row").isNotNull()).join(of_row, "row", "left").select("doc_id", "text", "spans")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 from texts and spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], []]
            for text, spans in zip(batch["text"].cast(pa.binary()).to_pylist(), batch["spans"]):
                runs = merged([(s["a"], s["b"]) for s in spans.as_py() or ()])
                kept, at = [], 0
                for a, b in runs:
                    kept.append(text[at:a])
                    at = b
                kept.append(text[at:])
                for c, v in zip(cols, (len(text), sum(b - a for a, b in runs), len(runs), hashlib.sha256(b"".join(kept)).hexdigest())):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *map(pa.array, cols, kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return found.mapInArrow(run, f"doc_id {found.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(repeats(table(spark, sf_dir, "documents")))
