"""Near-duplicates by the similarity of word shingles, with nothing missed.

Two texts are linked if the sets of their five-word shingles (A-Z lower-cased) have a Jaccard similarity of four fifths
or more; of each connected group one row stays. Texts with one SHA-256 digest are one; of these, texts whose sets have
the same number of shingles and the same sums of their hashes are compared with one of them by all their shingles, and
are one class from here on if these are equal (if not, they stay apart and are found as any other pair is).

Classes are searched by SimHash first: operator 7's 64-bit fingerprints and its generalised pigeonhole search give the
pairs within 3 bits, and those that are links by their texts make the first groups. Fingerprints miss links (at a
similarity of four fifths they differ in some ten bits), so an exact search goes on from these groups and compares only
what is in different ones. All shingles stand in one order, frequent ones last. Of two linked sets with n and m
shingles more than four fifths of the larger one are shared, so their first n // 5 + 1 and m // 5 + 1 shingles have one
in common: classes meet under these. Pairs that meet and aren't excluded by sizes, places and marks are verified by
their texts. A set's marks are ``MARKS`` bits or more, no fewer than it has shingles, each the parity of the number of
its shingles there: two sets differ in no fewer shingles than their marks in bits (longer marks are folded), so no link
is lost, and few others are left. Marks are fetched once for each pair; only in the last round do they go with the
lines, folded to ``MARKS`` bits.

Under a shingle with more than ``SMALL`` classes, those of like size are compared with one of them first. What is then
one group isn't compared again: ``LEADERS`` further rounds compare classes of like size with a leader of another group,
one that the shingle and the round choose, so large groups grow together with few pairs; the last round pairs all
classes that are still in different groups. Classes of a shingle with more than ``HOT`` are dealt out to several tasks,
in the last round by pairs of blocks of about ``HOT`` classes, so it also compares what the others dealt apart.

Defined results: null and empty texts have no shingles and are copies of each other; a text of one to four words has
one shingle, the whole of it; repeated rows are copies; rows without doc_id stay only if their group has no other
rows; an empty table gives an empty result; all columns are kept. Hashes of shingles only choose what is compared: each
link but that of equal digests is verified by bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.llm import simhash
from gridmix.llm.common import by_batch, components, discard, hashed_share, row_slices, scratch, staged, text_bytes
from gridmix.llm.decontam import CHUNK, exact_shingles, shingles
from gridmix.llm.hashing import mixed

#: Groups of more classes than this are compared in two rounds.
SMALL = 2
#: Frequent shingles are found in this share of the rows, or about so many rows; results don't depend on them.
SAMPLE_SHARE, SAMPLE_ROWS, SAMPLE_LEAST = 50, 20_000, 4
FREQUENT = 200_000
SALT = np.uint64(0x5851F42D4C957F2D)
#: Rounds with leaders before the last one.
LEADERS = 2
#: Bits of a set's marks at least, a power of two; classes of one block of a shingle's.
MARKS = 1024
HOT = 2000


def word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """XXH64 of every word, computed once for each different word of a slice."""
    import xxhash

    if not len(start):
        return np.zeros(0, np.uint64)
    inside = np.zeros(len(low) + 1, np.int8)
    inside[start] += 1
    np.add.at(inside, end, -1)  # a word may end where the next one starts, at the end of a row
    at = np.append(0, np.cumsum(end - start)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(low[np.cumsum(inside[:-1]) > 0])]).dictionary_encode()
    known = np.fromiter((xxhash.xxh64_intdigest(w) for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    return known[words.indices.to_numpy()]


def shingle_sets(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row, hash) of slices of a batch: each row's distinct shingles in order of hash."""
    raw, offsets = text_bytes(batch["text"])
    for a, b in row_slices(offsets, CHUNK):
        with np.errstate(over="ignore"):
            row, h = shingles(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], word_hashes=word_hashes)
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        first = np.append(True, (row[1:] != row[:-1]) | (h[1:] != h[:-1]))[: len(h)]
        yield a, b - a, row[first], h[first]


def frequent(rows: DataFrame) -> np.ndarray:
    """Hashes, sorted, of shingles that many rows of a sample have: FREQUENT at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, h in shingle_sets(batch):
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    n = rows.count()
    some = hashed_share(rows, n, max(SAMPLE_ROWS, n // SAMPLE_SHARE), "_row")
    many = some.select("text").mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SAMPLE_LEAST)
    top = many.orderBy(F.desc("n"), "h").limit(FREQUENT).select("h").collect()
    return np.sort(np.array([r["h"] for r in top], np.int64).view(np.uint64))


def sketches(rows: DataFrame, late: np.ndarray) -> DataFrame:
    """doc_id, _row, digest, n, s1 and s2 (two sums that stand for the set), first (the shingles it is found by, in
    order), marks, fp (the fingerprint)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, m, row, h in shingle_sets(batch):
                n = np.bincount(row, minlength=m)
                begin = np.cumsum(n) - n
                with np.errstate(over="ignore"):
                    sums = [np.append(np.uint64(0), np.cumsum(mixed(x))) for x in (h, h ^ SALT)]
                    s1, s2 = ((s[begin + n] - s[begin]).view(np.int64) for s in sums)
                    wide = np.array([max(MARKS, 1 << int(c - 1).bit_length()) for c in n], np.int64)
                    until = np.cumsum(wide)
                    bit = (mixed(h + SALT) & (wide[row] - 1).astype(np.uint64)).astype(np.int64)
                odd = np.bincount((until - wide)[row] + bit, minlength=int(until[-1])) & 1
                marks = np.packbits(odd.astype(np.uint8)).tobytes()
                marks = pa.array([marks[(u - w) // 8 : u // 8] for u, w in zip(until.tolist(), wide.tolist())], pa.binary())
                fp = pa.array([simhash.fingerprint(t) if t else 0 for t in batch["text"].slice(a, m).cast(pa.binary()).to_pylist()], pa.int64())
                last = late[np.minimum(np.searchsorted(late, h), len(late) - 1)] == h if len(late) else np.zeros(len(h), bool)
                order = np.lexsort((h, last, row))
                keep = order[np.arange(len(h)) - begin[row] < n[row] // 5 + 1]
                size = np.bincount(row[keep], minlength=m)
                first = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(h[keep].view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(batch[c].slice(a, m) for c in ("doc_id", "_row", "digest")), pa.array(n), pa.array(s1), pa.array(s2), first, marks, fp], ["doc_id", "_row", "digest", "n", "s1", "s2", "first", "marks", "fp"])

    digested = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    return digested.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, _row long, digest binary, n long, s1 long, s2 long, first array<long>, marks binary, fp long")


def folded(marks: bytes, size: int) -> int:
    """Marks of ``size`` bytes: longer ones are halved by exclusive or until they are no longer."""
    own, bits = int.from_bytes(marks), len(marks) * 8
    while bits > size * 8:
        bits //= 2
        own = (own >> bits) ^ (own & (1 << bits) - 1)
    return own


def likely(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """The different pairs (a, b) that sizes and marks leave."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = np.zeros(batch.num_rows, bool)
        for i, (n, m, x, y) in enumerate(zip(*(batch[c].to_pylist() for c in ("n", "m", "x", "y")))):
            size = min(len(x), len(y))
            keep[i] = min(n, m) * 5 >= max(n, m) * 4 and (folded(x, size) ^ folded(y, size)).bit_count() * 9 <= n + m
        return batch.select(["a", "b"]).filter(pa.array(keep))

    own, other = (marks.select(F.col("_row").alias(k), F.col("n").alias(n), F.col("marks").alias(v)) for k, n, v in (("a", "n", "x"), ("b", "m", "y")))
    return by_batch(pairs.distinct().join(own, "a").join(other, "b").select("a", "b", "n", "m", "x", "y"), run, "a long, b long")


def short(marks: DataFrame) -> DataFrame:
    """_row and its marks, folded to MARKS bits."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [folded(x, MARKS // 8).to_bytes(MARKS // 8) for x in batch["marks"].to_pylist()]
        return pa.RecordBatch.from_arrays([batch["_row"], pa.array(own, pa.binary())], ["_row", "marks"])

    return by_batch(marks.select("_row", "marks"), run, "_row long, marks binary")


def possible(n: np.ndarray, place: np.ndarray, marks: np.ndarray | None, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Where rows i and j can be linked if this is the first shingle they share, by sizes, places and any marks."""
    most = np.minimum(n[i] - place[i], n[j] - place[j])
    at = np.flatnonzero((np.minimum(n[i], n[j]) * 5 >= np.maximum(n[i], n[j]) * 4) & (most * 9 >= (n[i] + n[j]) * 4))
    if marks is None:
        return at
    differ = np.bitwise_count(marks[i[at]] ^ marks[j[at]]).sum(1, dtype=np.int64)
    return at[differ * 9 <= n[i[at]] + n[j[at]]]


def pairs_under(key, row, n, place, group, marks, small: int, turn: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) of different groups, for rows sorted by key and n. Keys of up to ``small`` rows give all their pairs,
    others pairs with a leader of each run of like size (its first row in turn 0); without a turn, all."""
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(start, len(key)))
    end = np.repeat(start + size, size)
    few = np.repeat(size <= small, size)
    none = np.zeros(0, np.int64)
    a, b = [none], [none]

    def take(i: int, j: np.ndarray) -> None:
        j = j[group[j] != group[i]]
        one, other = np.minimum(i, j), np.maximum(i, j)
        keep = possible(n, place, marks, one, other)
        a.append(one[keep])
        b.append(other[keep])

    for d in range(1, int(size[size <= small].max(initial=1))):
        i = np.flatnonzero(few[: len(key) - d] & (np.arange(len(key) - d) + d < end[: len(key) - d]) & (group[: len(key) - d] != group[d:]))
        i = i[possible(n, place, marks, i, i + d)]
        a.append(i)
        b.append(i + d)
    for s, c in zip(start[size > small], size[size > small]):
        if (group[s : s + c] == group[s]).all():
            continue
        if turn is None:
            for i in range(s, s + c - 1):
                take(i, np.arange(i + 1, s + int(np.searchsorted(n[s : s + c], n[i] * 5 // 4, side="right"))))
            continue
        while c > 1:
            like = int(np.searchsorted(n[s : s + c], n[s] * 5 // 4, side="right"))
            leader = s if turn == 0 else s + int(mixed(np.array([key[s]]).view(np.uint64) + np.uint64(turn))[0] % np.uint64(like))
            take(leader, np.delete(np.arange(s, s + like), leader - s))
            s, c = s + like, c - like
    i, j = row[np.concatenate(a)], row[np.concatenate(b)]
    pairs = np.unique(np.column_stack([np.minimum(i, j), np.maximum(i, j)]), axis=0)
    return pairs[:, 0], pairs[:, 1]


def candidates(keyed: DataFrame, small: int, turn: int | None, marks: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b). Rows of a key come sorted, batch after batch."""
    columns = ["key", "_row", "n", "place", "root"]
    marked = marks is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * len(columns) + [np.zeros((0, MARKS // 64), np.uint64)] * marked

        def out(own: list[np.ndarray]) -> pa.RecordBatch:
            a, b = pairs_under(*own[:5], own[5] if marked else None, small, turn)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            more = [batch[c].to_numpy().astype(np.int64) for c in columns]
            if marked:
                more.append(np.frombuffer(b"".join(batch["marks"].to_pylist()), np.uint64).reshape(-1, MARKS // 64))
            held = [np.concatenate([x, y]) for x, y in zip(held, more)]
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last key may go on
            if cut:
                yield out([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if len(held[0]):
            yield out(held)

    lines = keyed.select(*columns).join(short(marks), "_row") if marked else keyed.select(*columns)
    order = [*columns, "marks"] if marked else columns
    return lines.select(*order).repartition("key").sortWithinPartitions("key", "n", "_row").mapInArrow(run, "a long, b long")


def shared_keys(every: DataFrame) -> DataFrame:
    """Lines of the shingles that several classes have: most have one. Lines are dealt by shingle once and looked at as
    they pass, whatever their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last line so far, and whether the one before has its key
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.RecordBatch.from_arrays([pa.concat_arrays([x, y]) for x, y in zip(held.columns, batch.columns)], schema=batch.schema)
            key = batch["key"].to_numpy()
            same = key[1:] == key[:-1]
            keep = np.append(before == key[0], same) | np.append(same, False)
            yield batch.slice(0, len(key) - 1).filter(pa.array(keep[:-1]))
            held, before = batch.slice(len(key) - 1), key[-2] if len(key) > 1 else before
        if held is not None and before == held["key"][0].as_py():
            yield held

    return every.repartition("key").sortWithinPartitions("key").mapInArrow(run, every.schema)


def linked(rows: DataFrame, pairs: DataFrame, equal: bool = False) -> DataFrame:
    """Of different pairs (a, b) those of rows whose shingle sets have a similarity of four fifths or more, or are equal."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            last, own = None, set()
            for i, (a, x, y) in enumerate(zip(batch["a"].to_pylist(), batch["x"].cast(pa.binary()), batch["y"].cast(pa.binary()))):
                if a != last:
                    last, own = a, exact_shingles(x.as_py())
                other = exact_shingles(y.as_py())
                keep[i] = own == other if equal else len(own & other) * 9 >= (len(own) + len(other)) * 4
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    pairs = staged(pairs)
    wanted = pairs.select(F.col("a").alias("_row")).unionByName(pairs.select(F.col("b").alias("_row"))).distinct()
    own = staged(rows.select("_row", "text").join(wanted, "_row", "left_semi"))
    x, y = (own.select(F.col("_row").alias(k), F.col("text").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def in_blocks(keyed: DataFrame, hot: int) -> DataFrame:
    """Lines under keys of their own for every two blocks of a key with more than ``hot`` lines."""
    blocks = F.ceil(F.col("c") / hot).cast("int")
    own, other = F.pmod(F.xxhash64("_row"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = keyed.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", other)
    key = F.when(F.col("blocks") == 1, F.col("key")).otherwise(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
    return dealt.withColumn("key", key).drop("blocks", "own", "other")


def dealt_apart(keyed: DataFrame, hot: int, turn: int = 0) -> DataFrame:
    """Lines of a key with more than ``hot`` under several keys, at random and otherwise each turn."""
    share = F.pmod(F.xxhash64("_row", F.lit(turn)), F.ceil(F.col("c") / hot))
    return keyed.withColumn("key", F.when(F.col("c") > hot, F.xxhash64("key", share)).otherwise(F.col("key")))


def classes_of(rows: DataFrame, found: DataFrame) -> DataFrame:
    """One line for all texts with equal shingle sets, that of the least row: n, no_id, doc_id, _row, first, marks, fp."""
    own = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row", "first", "marks", "fp")).alias("own")
    texts = staged(found.groupBy("s1", "s2", "n", "digest").agg(own).select("s1", "s2", "n", "own.*"))
    least = F.min(F.struct("no_id", "doc_id", "_row")).alias("least")
    several = texts.groupBy("s1", "s2", "n").agg(least, F.count(F.lit(1)).alias("c")).where("c > 1").select("s1", "s2", "n", F.col("least._row").alias("a"))
    equal = staged(linked(rows, texts.join(several, ["s1", "s2", "n"]).where("a <> _row").select("a", F.col("_row").alias("b")), equal=True))
    return staged(texts.join(equal.select(F.col("b").alias("_row")), "_row", "left_anti").select("n", "no_id", "doc_id", "_row", "first", "marks", "fp"))


def fingerprint_pairs(classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes by operator 7: of equal fingerprints with the least row, and of linked fingerprints."""
    distinct = staged(classes.groupBy("fp").agg(F.min("_row").alias("row")))
    equal = classes.select("fp", "_row").join(distinct, "fp").where("_row <> row").select(F.col("row").alias("a"), F.col("_row").alias("b"))
    x, y = (distinct.select(F.col("fp").alias(k), F.col("row").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    near = simhash.edges_of(distinct).distinct().join(x, "a").join(y, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return equal.unionByName(near)


def groups_of(rows: DataFrame, classes: DataFrame, small: int, hot: int) -> DataFrame:
    """(node, root) for all classes that link to another one."""
    marks = classes.select("_row", "n", "marks")
    groups = components(staged(linked(rows, likely(fingerprint_pairs(classes), marks))))
    every = classes.select("_row", "n", F.posexplode("first").alias("place", "key")).select("_row", F.col("n").cast("int").alias("n"), F.col("place").cast("int").alias("place"), "key")
    several = staged(shared_keys(every))  # shingles of one class go
    keyed = staged(several.join(several.groupBy("key").agg(F.count(F.lit(1)).alias("c")), "key"))
    discard(several)
    before, left = keyed, keyed
    turn = 0
    while turn <= LEADERS + 1:
        known = left.join(groups.withColumnRenamed("node", "_row"), "_row", "left").withColumn("root", F.coalesce("root", "_row"))
        split = known.groupBy("key").agg(F.min("root").alias("u"), F.max("root").alias("v")).where("u <> v").select("key")
        known = staged(known.join(split, "key", "left_semi"))
        discard(before)
        if known.isEmpty():
            break
        before, left = known, known.drop("root").where(F.col("c") > small)
        last = turn > LEADERS
        pairs = candidates(in_blocks(known, hot), 1, None, marks) if last else candidates(dealt_apart(known, hot, turn), 1 if turn else small, turn)
        more = staged(linked(rows, likely(pairs, marks)))
        found = not more.isEmpty()
        if found:
            groups = components(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
        discard(more)
        turn = turn + 1 if found or not turn else max(turn, LEADERS) + 1  # a round without links is followed by the last one
    return groups


def keep_one(docs: DataFrame, small: int = SMALL, hot: int = HOT) -> DataFrame:
    """One row of each group of near copies stays, that with the least doc_id; all columns are kept."""
    name = next(n for n in (f"_row{i}" for i in range(len(docs.columns) + 1)) if n not in map(str.lower, docs.columns))
    with scratch(docs.sparkSession) as kept:
        numbered = staged(docs.withColumn(name, F.monotonically_increasing_id()))  # read several times: the numbers are stored
        rows = numbered.select(F.col(name).alias("_row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
        classes = classes_of(rows, sketches(rows, frequent(rows)))
        known = classes.join(groups_of(rows, classes, small, hot).withColumnRenamed("node", "_row"), "_row", "left")
        least = known.groupBy(F.coalesce("root", "_row").alias("root")).agg(F.min(F.struct("no_id", "doc_id", "_row")).alias("least"))
        least = staged(least.select(F.col("least._row").alias(name)))
        kept += [numbered, least]
    return numbered.join(least, name, "left_semi").drop(name)
