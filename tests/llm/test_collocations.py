"""Phrase collocations against plain counting, and the stripes' own figures."""

import random
import re
from collections import Counter, defaultdict

import pytest

from gridmix.llm import collocations

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, most_words=4, subsumed=80):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOW)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, most_words + 1):
                for i in range(len(w) - m + 1):
                    f[lang][tuple(w[i : i + m])] += 1
    out = {}
    for lang, count in f.items():
        many = {p: a for p, a in count.items() if a >= least and len(p) > 1}
        gone = set()
        for q, b in many.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    p = q[i : i + m]
                    if 100 * b >= subsumed * many[p]:
                        gone.add(p)
        for p, a in many.items():
            if p not in gone:
                score, cut = min((2000000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
                out[lang, " ".join(p)] = (a, count[p[:cut]], count[p[cut:]], n[lang], score)
    return out


def texts(rng, n):
    """Words of a skewed distribution, with a passage in a third of the rows, one hot word, odd pieces and scripts."""
    out = []
    for i in range(n):
        w = [f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(rng.randrange(60))]
        if i % 3 == 0:
            w[3:3] = "The quick Brown fox über die Straße".split()
        if i % 7 == 0:
            w += ["hot"] * 40
        t = "".join(x + rng.choice([" ", " ", " ", "\t", "  ", ", ", "\n", "."]) for x in w)
        out.append((t, rng.choice(["en", "de", None])))
    return [*out, (None, "en"), ("", None), (" .;\n", "fr"), ("x y x y x y\x00 x y", "fr"), ("ÀB àb ÀB", "fr")]


def rows_of(spark, rows):
    full = [(i, t, lang, "s", len(t or ""), f"clash{i}") for i, (t, lang) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, prefix string").repartition(5, "doc_id")


def found(df):
    return {(r["lang"], r["phrase"]): (r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("chunk, most, segment", [(collocations.CHUNK, collocations.MOST, collocations.SEGMENT), (900, 25, 40)])
def test_phrases(spark, monkeypatch, chunk, most, segment):
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    monkeypatch.setattr(collocations, "SEGMENT", segment)
    rows = texts(random.Random(4), 220)
    got = found(collocations.collocations(rows_of(spark, rows), least=6, most=most))
    assert got == plain(rows, 6)
    assert {len(p.split(" ")) for _, p in got} == {2, 3, 4}


def test_stripes(spark):
    """Totals of stripes are counts of their prefixes; elements are counts of the longer phrases."""
    rows = [("a b a c a b, a b\nb a", "en"), ("a b", "en")]
    levels = collocations.mined(rows_of(spark, rows), least=2, most_words=2)
    roots = levels[0].collect()
    assert sum(r["total"] for r in roots) == 12
    totals = {r["prefix"]: r["total"] for r in levels[1].collect()}
    assert totals == {"a": 6, "b": 5}
    assert {r["phrase"]: r["a"] for r in collocations.phrases_of(levels[1]).collect()} == {"a b": 4, "b a": 2}


def test_top(spark):
    rows = [("en", f"p {i}", i % 3 + 1, 1, 1, 9, i % 5) for i in range(500)] + [("de", "q", 1, 1, 1, 9, 7)]
    df = spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, n long, score long")
    want = [x[1] for x in sorted((r for r in rows if r[0] == "en"), key=lambda x: (-x[6], -x[2], x[1].encode()))][:120]
    got = collocations.top(df, 120).where("lang = 'en'").orderBy("rank").collect()
    assert [r["phrase"] for r in got] == want and [r["rank"] for r in got] == list(range(1, 121))


def test_odd_tables(docs, empty):
    assert collocations.top(collocations.collocations(empty)).count() == 0
    collocations.top(collocations.collocations(docs)).collect()
