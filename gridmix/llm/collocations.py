"""Phrase collocation mining by stripes.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these at spaces and tabs into words. A
stripe is a prefix of k words with a counter of the words that follow it. Every task gathers the stripes of a slice of
texts; stripes of one prefix are merged element by element. Level 0 has the empty prefix: its total is the number of
words n, its elements are the words. Each further level extends phrases of k words that occur ``LEAST`` times or more
(a part of a phrase is never rarer than the phrase, so nothing is lost); followers that can't make a frequent phrase
and ends of pieces are gathered under an empty element, so a stripe's total is the count of its prefix.

One structure gives all figures: elements are extensions and their counts, totals are counts of prefixes, the largest
element subsumes its prefix, and the largest element by the rest of its words subsumes these. Of two phrases with one
longer than the other by several words there is a chain of phrases between them that are at least as frequent as the
longer one, so extensions by one word decide about subsumption.

Stripes of frequent prefixes are cut into segments by a hash of the following word, in proportion to the prefix's
count, so no stripe grows with the table. Tasks know the frequent phrases by their hashes, at most ``MOST`` at a time:
if there are more, the prefixes are gone through in several passes by ranges of hashes. Hashes only leave out work:
elements are counted by their words.

Defined results: null texts are empty and give no words; a null lang is ``und``; repeated rows count each time; texts
of any length are cut at ends of pieces; an empty table gives an empty result; only text and lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridmix.llm.common import staged, table, text_bytes
from gridmix.llm.hashing import mixed

#: Least occurrences of a phrase, its longest number of words, per cent at which a longer phrase stands for it, rows per lang.
LEAST, WORDS, SUBSUMED, TOP = 30, 4, 80, 2000
#: Bytes of text from which a task gathers stripes at once.
CHUNK = 8 << 20
#: Hashes of frequent phrases of one length that tasks hold at a time.
MOST = 2_000_000
#: A stripe has one segment for so many occurrences of its prefix; the empty prefix has so many segments.
SEGMENT, ROOT_SEGMENTS = 1 << 16, 512
GAP, END = 1, 2
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t")] = GAP
KIND[list(b".,;:!?\n\x0b\x0c\r")] = END
NAMES = ["lang", "prefix", "seg", "words", "counts"]
STRIPES = "lang string, prefix string, seg int, words string, counts binary"


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[str]]]:
    """(bytes, offsets of rows, lang of each row) of about CHUNK bytes each; a longer text is cut at an end of a piece."""
    raws, ends, langs, held = [], [], [], 0

    def out() -> tuple[np.ndarray, np.ndarray, list[str]]:
        return np.concatenate(raws), np.append(0, np.cumsum(ends)), langs

    for batch in batches:
        raw, offsets = text_bytes(batch["text"])
        for i, lang in enumerate(batch["lang"].to_pylist()):
            own = raw[offsets[i] : offsets[i + 1]]
            while len(own):
                part = own
                if len(own) > CHUNK:
                    cut = np.flatnonzero(KIND[own[CHUNK:]] == END)
                    part = own[: CHUNK + cut[0] + 1] if len(cut) else own
                own = own[len(part) :]
                raws.append(part)
                ends.append(len(part))
                langs.append(lang)
                held += len(part)
                if held >= CHUNK:
                    yield out()
                    raws, ends, langs, held = [], [], [], 0
    if held:
        yield out()


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, piece, row): every word of a slice, the number of its piece and its row."""
    raw = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
    kind = KIND[raw]
    word = kind == 0
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(word & (np.append(True, ~word[:-1]) | edge[:-1]))
    end = np.flatnonzero(word & (np.append(~word[1:], True) | edge[1:])) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    piece = np.cumsum(kind == END)[start] + row
    at = np.append(0, np.cumsum(end - start)).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(raw[word])]), piece, row


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def chained(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those of all words but the last and of the last."""
    with np.errstate(over="ignore"):
        return mixed(left * np.uint64(0x9E3779B97F4A7C15) + word)


def known(frequent: np.ndarray, h: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(h), bool)
    return frequent[np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)] == h


def stripes_of(raw: np.ndarray, offsets: np.ndarray, langs: list[str], k: int, frequent: list[np.ndarray | None], own: tuple[np.ndarray, np.ndarray, bool]) -> pa.RecordBatch | None:
    """The stripes of the prefixes of k words in one slice. ``frequent`` has the sorted hashes of the frequent phrases
    of 1 to k - 1 words (None: too many to hold); ``own`` those of k words with their counts, and if these are all."""
    words, piece, row = words_of(raw, offsets)
    if not len(words):
        return None
    encoded = words.dictionary_encode()
    word, names = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary.cast(pa.binary())
    tongues = sorted(set(langs))
    number = {x: i for i, x in enumerate(tongues)}
    v, n = len(names), len(word)
    hashed = word_hashes(names.to_pylist())
    # Phrases that start at the places in ``live`` have the numbers ``code``; by number: hash, and words.
    live, code = np.arange(n), np.array([number[x] for x in langs], np.int64)[row]
    phrases, spelled, tongue = word_hashes([x.encode() for x in tongues]), np.zeros((len(tongues), 0), np.int64), np.arange(len(tongues))
    whole = np.full(n + 1, -1, np.int64)
    for j in range(1, k + 1):
        if j > 1:  # what follows the first word must be frequent and in the same piece
            keep = (live + j - 1 < n) & (whole[np.minimum(live + 1, n)] >= 0)
            live, code = live[keep], code[keep]
            keep = piece[live] == piece[live + j - 1]
            live, code = live[keep], code[keep]
        u, inverse = np.unique(code * v + word[live + j - 1], return_inverse=True)
        phrases = chained(phrases[u // v], hashed[u % v])
        asked = own[0] if j == k else frequent[j - 1]
        good = np.ones(len(u), bool) if asked is None else known(asked, phrases)
        spelled, tongue, phrases = np.column_stack([spelled[u // v], u % v])[good], tongue[u // v][good], phrases[good]
        keep = good[inverse]
        live, code = live[keep], (np.cumsum(good) - 1)[inverse[keep]]
        whole[:] = -1
        whole[live] = code
    if not len(live):
        return None
    after = np.minimum(live + k, n - 1)
    inside = (live + k < n) & (piece[after] == piece[live])
    if k and own[2]:  # the last k words of the longer phrase must be frequent too
        inside &= whole[np.minimum(live + 1, n)] >= 0
    u, count = np.unique(code * (v + 1) + np.where(inside, word[after], v), return_counts=True)
    prefix, after = u // (v + 1), u % (v + 1)
    segments = 1 + own[1][np.searchsorted(own[0], phrases)] // SEGMENT if k else np.full(len(phrases), ROOT_SEGMENTS)
    seg = (np.append(hashed, np.uint64(0))[after] % segments[prefix].astype(np.uint64)).astype(np.int32)
    order = np.lexsort((seg, prefix))
    prefix, after, seg, count = prefix[order], after[order], seg[order], count[order]
    start = np.flatnonzero(np.append(True, (prefix[1:] != prefix[:-1]) | (seg[1:] != seg[:-1])))
    spelling = [b" ".join(w) for w in zip(*(names.take(pa.array(c)).to_pylist() for c in spelled.T))] if k else [b""] * len(tongues)
    own_prefix = prefix[start]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(tongues, pa.string()).take(pa.array(tongue[own_prefix])), pa.array(spelling, pa.binary()).cast(pa.string()).take(pa.array(own_prefix)), pa.array(seg[start]),
            joined(pa.concat_arrays([names, pa.array([b""], pa.binary())]).take(pa.array(after)).cast(pa.string()), np.append(start, len(after))), as_binary(count, np.append(start, len(after))),
        ], NAMES,
    )


def joined(words: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words), " ")


def as_binary(numbers: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * 8).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(numbers, np.int64))])


def elements(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(word, count, row) of all elements of stripes."""
    lists = pc.split_pattern(batch["words"], " ")
    row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return lists.flatten(), np.frombuffer(b"".join(batch["counts"].to_pylist()), np.int64), row


def merged(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Stripes of one key, sorted by it, are added element by element: total, and the elements of ``least`` or more."""
    held: pa.RecordBatch | None = None

    def step(batch: pa.RecordBatch, last: bool) -> tuple[pa.RecordBatch | None, pa.RecordBatch | None]:
        change = np.zeros(batch.num_rows - 1, bool)
        for c in NAMES[:3]:
            change |= pc.not_equal(batch[c].slice(1), batch[c].slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(np.append(True, change))
        group = np.cumsum(np.append(False, change))
        word, n, row = elements(batch)
        encoded = word.dictionary_encode()
        v = len(encoded.dictionary)
        code = group[row] * v + encoded.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        code = code[order]
        start = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        n, code = np.add.reduceat(n[order], start), code[start]
        group, word = code // v, encoded.dictionary.take(pa.array(code % v))
        begin = np.searchsorted(group, np.arange(len(first) + 1))
        keys = [batch[c].take(pa.array(first)) for c in NAMES[:3]]
        done = len(first) if last else len(first) - 1
        rest = None
        if not last:  # the last key may go on in the next batch
            at = begin[done]
            rest = pa.RecordBatch.from_arrays([*(x.slice(done) for x in keys), joined(word.slice(at), np.array([0, len(n) - at])), as_binary(n[at:], np.array([0, len(n) - at]))], NAMES)
        if not done:
            return None, rest
        total = np.add.reduceat(n[: begin[done]], begin[:done])
        keep = np.flatnonzero((n >= least) & (group < done) & (pc.binary_length(word).to_numpy(zero_copy_only=False) > 0))
        cut = np.searchsorted(group[keep], np.arange(done + 1))
        # No element left gives a null, as the empty text is an element of its own.
        text = pc.if_else(pa.array(np.diff(cut) > 0), joined(word.take(pa.array(keep)), cut), pa.scalar(None, pa.string()))
        return pa.RecordBatch.from_arrays([*(x.slice(0, done) for x in keys), text, as_binary(n[keep], cut), pa.array(total)], [*NAMES, "total"]), rest

    for batch in batches:
        if not batch.num_rows:
            continue
        batch = batch.select(NAMES)
        if held is not None:
            batch = pa.RecordBatch.from_arrays([pa.concat_arrays([held[c], batch[c]]) for c in NAMES], NAMES)
        out, held = step(batch, False)
        if out is not None:
            yield out
    if held is not None:
        yield step(held, True)[0]


def phrases_of(stripes: DataFrame) -> DataFrame:
    """The elements of merged stripes: lang, prefix, phrase, a, and h, the phrase's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch["words"]))
            if not batch.num_rows:
                continue
            word, n, row = elements(batch)
            before = word_hashes([x.encode() for x in batch["lang"].to_pylist()])
            for i, p in enumerate(batch["prefix"].to_pylist()):
                for w in word_hashes(p.encode().split(b" ")) if p else ():
                    before[i] = chained(before[i : i + 1], w)[0]
            h = chained(before[row], word_hashes(word.cast(pa.binary()).to_pylist()))
            at = pa.array(row)
            prefix = batch["prefix"].take(at)
            phrase = pc.if_else(pc.equal(prefix, ""), word, pc.binary_join_element_wise(prefix, word, " "))
            yield pa.RecordBatch.from_arrays([batch["lang"].take(at), prefix, phrase, pa.array(n), pa.array(h.view(np.int64))], ["lang", "prefix", "phrase", "a", "h"])

    return stripes.mapInArrow(run, "lang string, prefix string, phrase string, a long, h long")


def mined(docs: DataFrame, least: int = LEAST, most_words: int = WORDS, most: int = MOST) -> list[DataFrame]:
    """The merged stripes of prefixes of 0 to most_words - 1 words: lang, prefix, seg, words, counts, total."""
    spark = docs.sparkSession
    rows = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    levels: list[DataFrame] = []
    frequent: list[np.ndarray | None] = []
    for k in range(most_words):
        passes: list[tuple[np.ndarray, np.ndarray, bool]] = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), True)]
        if k:
            grams = phrases_of(levels[-1]).select("h", "a")
            times = max(1, -(-grams.count() // most))
            passes = [held(grams.where(F.pmod("h", F.lit(times)) == r), times == 1) for r in range(times)]
        merged_stripes = [one_pass(rows, k, spark.sparkContext.broadcast((frequent, own)), least) for own in passes]
        levels.append(staged(reduce(DataFrame.unionByName, merged_stripes)))
        if k:
            frequent = [*frequent, passes[0][0] if len(passes) == 1 else None]
    return levels


def held(grams: DataFrame, whole: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Sorted hashes and counts of phrases, MOST of them at most; of equal hashes the larger count."""
    found = grams.toArrow()
    h, a = found["h"].to_numpy().view(np.uint64), found["a"].to_numpy()
    order = np.lexsort((-a, h))
    h, first = np.unique(h[order], return_index=True)
    return h, a[order][first], whole


def one_pass(rows: DataFrame, k: int, given, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, own = given.value
        for raw, offsets, langs in slices(batches):
            if (out := stripes_of(raw, offsets, langs, k, frequent, own)) is not None:
                yield from (out.slice(i, 1000) for i in range(0, out.num_rows, 1000))

    keyed = rows.mapInArrow(run, STRIPES).repartition(*NAMES[:3]).sortWithinPartitions(*NAMES[:3])
    return keyed.mapInArrow(partial(merged, least=least), STRIPES + ", total long")


def collocations(docs: DataFrame, least: int = LEAST, most_words: int = WORDS, subsumed: int = SUBSUMED, most: int = MOST) -> DataFrame:
    """lang, phrase, a, l, r, n and score of every candidate that no longer one stands for."""
    levels = mined(docs, least, most_words, most)
    union = partial(reduce, DataFrame.unionByName)
    totals = [s.groupBy("lang", "prefix").agg(F.sum("total").alias("total")) for s in levels]
    grams = [phrases_of(s).withColumn("m", F.lit(k + 1)) for k, s in enumerate(levels)]
    firsts = union([t.select("lang", F.col("prefix").alias("first"), F.col("total").alias("l")) for t in totals[1:]])
    rests = union([g.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")) for g in grams[:-1]])
    longer = [g.select("lang", F.explode(F.array("prefix", F.expr("substring_index(phrase, ' ', 1 - m)"))).alias("phrase"), "a") for g in grams[2:]]
    longest = union(longer).groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    own = union(grams[1:]).select("lang", "phrase", "m", "a").join(longest, ["lang", "phrase"], "left")
    own = own.where(F.col("most").isNull() | (wide("most") * 100 < wide("a") * subsumed)).drop("most")
    cuts = own.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cuts = cuts.withColumns({"first": F.expr("substring_index(phrase, ' ', cut)"), "rest": F.expr("substring_index(phrase, ' ', cut - m)")})
    scored = cuts.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"]).withColumn("score", F.expr("cast(a as decimal(30,0)) * 2000000 div (cast(l as decimal(20,0)) + r)"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("x"))
    n = totals[0].select("lang", F.col("total").alias("n"))
    return lowest.join(n, "lang").select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")


def top(found: DataFrame, rows: int = TOP) -> DataFrame:
    """The first rows of each lang with their ranks. A lang's rows are dealt out first and each share gives its first
    ones, so the last window gets few rows of each share."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = found.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    some = share.withColumn("rank", F.row_number().over(W.partitionBy("lang", "_share").orderBy(*order))).where(F.col("rank") <= rows)
    last = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= rows)
    return last.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top(collocations(table(spark, sf_dir, "documents")))


def _cuts() -> str:
    out = []
    for m in range(2, WORDS + 1):
        for j in range(1, m):
            key = lambda a, b: f"concat_ws(' ', {', '.join(f'w{i}' for i in range(a, b + 1))})"
            out.append(f"SELECT lang, {m} AS m, {key(1, m)} AS phrase, a, {j} AS cut, {key(1, j)} AS head, {key(j + 1, m)} AS tail FROM grams WHERE m = {m}")
    return " UNION ALL ".join(out)


def _grams() -> str:
    one = "SELECT lang, {m} AS m, {own}, count(*) AS a FROM runs WHERE {whole} GROUP BY ALL"
    rows = []
    for m in range(1, WORDS + 1):
        own = ", ".join(f"w{i}" if i <= m else f"CAST(NULL AS VARCHAR) AS w{i}" for i in range(1, WORDS + 1))
        rows.append(one.format(m=m, own=own, whole=f"w{m} IS NOT NULL") + f" HAVING count(*) >= {LEAST}")
    return " UNION ALL ".join(rows)


SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
numbered AS (SELECT lang, row_number() OVER () AS p, list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '') AS ws FROM pieces),
words AS (SELECT lang, p, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i FROM numbered WHERE len(ws) > 0),
runs AS (SELECT lang, w1, {', '.join(f'lead(w1, {i - 1}) OVER (PARTITION BY p ORDER BY i) AS w{i}' for i in range(2, WORDS + 1))} FROM words),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
grams AS (SELECT * FROM ({_grams()})),
named AS (SELECT lang, m, concat_ws(' ', w1, w2, w3, w4) AS phrase, a FROM grams),
cuts AS ({_cuts()}),
scored AS (
  SELECT c.lang, c.m, c.phrase, c.a, c.cut, h.a AS l, t.a AS r, CAST((CAST(2000000 AS HUGEINT) * c.a) // (h.a + t.a) AS BIGINT) AS score
  FROM cuts c JOIN named h ON h.lang = c.lang AND h.phrase = c.head JOIN named t ON t.lang = c.lang AND t.phrase = c.tail),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, concat_ws(' ', w1, w2) AS phrase, a FROM grams WHERE m >= 3 UNION ALL SELECT lang, concat_ws(' ', w2, w3), a FROM grams WHERE m >= 3
    UNION ALL SELECT lang, concat_ws(' ', w3, w4), a FROM grams WHERE m = 4
    UNION ALL SELECT lang, concat_ws(' ', w1, w2, w3), a FROM grams WHERE m = 4 UNION ALL SELECT lang, concat_ws(' ', w2, w3, w4), a FROM grams WHERE m = 4)
  GROUP BY lang, phrase),
kept AS (
  SELECT x.* FROM lowest x LEFT JOIN longer y ON y.lang = x.lang AND y.phrase = x.phrase
  WHERE y.most IS NULL OR CAST(100 AS HUGEINT) * y.most < CAST({SUBSUMED} AS HUGEINT) * x.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY k.score DESC, k.a DESC, encode(k.phrase)) AS rank, k.phrase, k.a, k.l, k.r, t.n, k.score
FROM kept k JOIN totals t ON t.lang = k.lang QUALIFY rank <= {TOP}
"""
