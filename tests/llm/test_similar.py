"""Near copies by exact similarity of five-word shingles: all pairs compared by brute force."""

import itertools
import os
import random

import numpy as np
import pytest

import corpus_pipeline
from gridmix.llm import similar, simhash
from gridmix.llm.decontam import exact_shingles
from tests.llm.conftest import sf, words
from tests.llm.test_near import near_rows


def plain_kept(rows):
    sets = [exact_shingles((t or "").encode()) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if len(sets[a] & sets[b]) * 5 >= len(sets[a] | sets[b]) * 4:
            root[find(a)] = find(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc_id)
    return sorted(min(x) for x in least.values())


def edited_rows():
    """Copies with few to many words changed, some by a chain, under a passage that very many texts share."""
    rng = random.Random(31)
    passage, texts = words(rng, 25), []
    for size in (8, 30, 90, 250, 700):
        base = words(rng, size, 4000).split()
        for _ in range(12):
            own = list(base)
            for _ in range(rng.randrange(1 + size // 30)):
                own[rng.randrange(size)] = f"y{rng.randrange(999)}"
            texts.append(" ".join(own[: rng.randrange(size * 8 // 10, size + 1)]))
    texts += [f"{words(rng, 40, 4000)} {passage} {words(rng, 40, 4000)}" for _ in range(40)]
    texts += [None, "", " \n", "Two words", "two WORDS", "x", "X"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("small, hot", [(similar.SMALL, similar.HOT), (16, similar.HOT), (similar.SMALL, 5)])
def test_all_near_copies_are_found(spark, small, hot):
    for rows in (edited_rows(), [r for r in near_rows() if r[0] is not None]):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert sorted(r["doc_id"] for r in similar.keep_one(df, small, hot).collect()) == plain_kept(rows)


def test_marks_never_exclude_a_link():
    rng = np.random.default_rng(3)
    for size in (1, 9, 40, 400, 4000):
        for share in (0.0, 0.8, 0.9, 1.0):
            h = rng.integers(0, 1 << 63, 2 * size).astype(np.uint64)
            both = int(size * share + 0.999)
            sets = [set(h[:size].tolist()), set(h[size - both : 2 * size - both].tolist())]
            marks = np.zeros((2, similar.MARKS // 64), np.uint64)
            for own, x in zip(marks, sets):
                for v in x:
                    own[v % similar.MARKS // 64] ^= np.uint64(1 << v % 64)
            n = np.array([len(x) for x in sets])
            found = similar.possible(n, np.zeros(2, np.int64), marks, np.array([0]), np.array([1]))
            if len(sets[0] & sets[1]) * 5 >= len(sets[0] | sets[1]) * 4:
                assert len(found) == 1
            elif share == 0 and 9 <= size <= 400:
                assert len(found) == 0


def test_stage_finds_what_three_bits_miss(spark):
    df = spark.read.parquet(f"{sf()}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    kept = sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, df, sf()).collect())
    assert kept == plain_kept(rows)
    assert len(kept) < simhash.keep_one(df).count()


def test_odd_rows(spark, docs, empty):
    assert similar.keep_one(docs).columns == docs.columns and similar.keep_one(empty).count() == 0
    assert similar.keep_one(docs.where("doc_id IS NULL")).count() == 1


def test_unlike_texts_stay(spark):
    """Words that collide under every polynomial hash modulo 2**64 are still different words."""
    morse = "".join("ab"[i.bit_count() & 1] for i in range(1024))
    other = morse.translate(str.maketrans("ab", "ba"))
    rows = [(1, morse), (2, other), (3, "hello"), (4, f"{morse} one two three four five"), (5, f"{other} one two three four five"), (6, other)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in similar.keep_one(df).collect()) == [1, 2, 3, 4, 5]


def test_equal_sums_of_unequal_sets(spark, monkeypatch):
    """With sums of hashes that are all equal, texts are told apart by their shingles."""
    monkeypatch.setattr(similar, "mixed", lambda h: h * np.uint64(0))
    rows = [(i, t) for i, t in edited_rows() if i % 3 == 0]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert sorted(r["doc_id"] for r in similar.keep_one(df).collect()) == plain_kept(rows)


def test_staged_tables_go(spark):
    from gridmix.llm import common

    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(os.listdir(base))
    out = similar.keep_one(spark.createDataFrame(edited_rows(), "doc_id long, text string"))
    assert len(set(os.listdir(base)) - before) == 2 and out.count() and not common._scratch


def test_fingerprints_come_first(spark, monkeypatch):
    """Without the search by shingles, SimHash finds long near copies, and no pair that isn't one by its texts."""
    rng = random.Random(7)
    base = words(rng, 600, 4000).split()
    near = [*base[:300], "changed", *base[301:]]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, words(rng, 600, 4000)), (4, "a b c d e f"), (5, "A b c\td e f"), (6, "")]
    monkeypatch.setattr(similar, "candidates", lambda keyed, *_: keyed.selectExpr("_row AS a", "_row AS b").limit(0))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert sorted(r["doc_id"] for r in similar.keep_one(df).collect()) == [1, 3, 4, 6] == plain_kept(rows)


def test_marks_of_long_sets_still_tell(spark):
    """Sets of thousands of shingles: unlike ones go before any text is read, like ones stay, also of other widths."""
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 1 << 40, 4600)]
    texts = [base, base[:3700], [*base[:2000], "x", *base[2001:]], [f"w{x}" for x in rng.integers(0, 1 << 40, 4600)], base[:2300] * 2]
    rows = spark.createDataFrame([(i, i, b"", " ".join(t)) for i, t in enumerate(texts)], "doc_id long, _row long, digest binary, text string")
    marks = similar.sketches(rows.drop("digest"), np.zeros(0, np.uint64)).select("_row", "n", "marks")
    assert {len(r["marks"]) for r in marks.collect()} == {512, 1024}
    pairs = spark.createDataFrame([(i, j) for i in range(5) for j in range(i + 1, 5)] * 2, "a long, b long")
    assert sorted(map(tuple, similar.likely(pairs, marks).collect())) == [(0, 1), (0, 2), (1, 2)]
