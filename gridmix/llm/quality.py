"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Per text the base counts, which are part of the result, are computed once. Further rules are then tried in order of
rejections per cost, both measured on a sample by a hash of the ids; the first rule that rejects ends the cascade, so
the order changes the time and never the verdict. No row is shuffled.

Defined results: null and empty texts have no words and fail the base rule; very long texts are sorted by window
hash, never compared pairwise; repeated rows give repeated results; an empty table gives an empty result; columns of
the input other than doc_id and text are not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.llm.common import SPACE, SPACE_CHARS, hashed_share, staged, table

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]+"
#: About how many documents the order of the rules is estimated on; no count or verdict depends on it.
SAMPLE_ROWS = 2000
#: Times that a rule is tried on each document of the sample to measure its cost.
TIMES = 12

#: name -> condition under which a text is rejected, over the base counts and the text; the same SQL runs in DuckDB.
RULES = {
    "symbols": "n_symbols * 10 > n_words * 4",
    "word_length": "word_chars < n_words * 2 OR word_chars > n_words * 15",
    "duplicate_lines": "n_dup_lines * 2 > n_lines",
    "shouting": "length(regexp_replace(text, '[^A-Z]+', '', 'g')) * 2 > word_chars",
    "letters": r"length(regexp_replace(text, '\P{L}+', '', 'g')) * 10 < word_chars * 6",
}


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def repeated_words(w: Column, k: int = WINDOW, hashed: Callable[..., Column] = F.xxhash64) -> Column:
    """How many words lie in windows of k words that occur twice or more in the text.

    Only texts with a repeated hash of a window are sorted, by hash and place; windows with one hash are neighbours then
    and are compared by their words. Should two of them differ, that text is sorted by the words as well.
    """
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: hashed(*[F.get(w, i + j) for j in range(k)]))
    window = lambda x: F.slice(w, x["i"] + 1, k)

    def covered(s: Column) -> Column:
        """Of places sorted so that equal windows are neighbours with one g."""
        like = lambda x, y: F.coalesce(y["g"] == x["g"], F.lit(False))
        twice = F.filter(s, lambda x, j: like(x, F.get(s, j - 1)) | like(x, F.get(s, j + 1)))
        starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
        widths = let(starts, lambda p: F.transform(p, lambda x, j: F.least(F.lit(k), F.coalesce(F.get(p, j + 1) - x, F.lit(k)))))
        return F.aggregate(widths, F.lit(0).cast("bigint"), lambda total, x: total + x)

    def sorted_places(h: Column) -> Column:
        by_hash = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
        by_words = F.array_sort(F.transform(h, lambda x, i: F.struct(F.struct(x.alias("h"), F.slice(w, i + 1, k).alias("words")).alias("g"), i.alias("i"))))
        differ = lambda s: F.exists(F.sequence(F.lit(1), F.size(s) - 1), lambda j: (F.get(s, j)["g"] == F.get(s, j - 1)["g"]) & (window(F.get(s, j)) != window(F.get(s, j - 1))))
        return let(by_hash, lambda s: F.when(differ(s), let(by_words, covered)).otherwise(covered(s)))

    some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), sorted_places(h)).otherwise(F.lit(0).cast("bigint")))
    return F.when(F.size(w) > k, some).otherwise(F.lit(0).cast("bigint"))


def counts(docs: DataFrame) -> DataFrame:
    """The base counts of every text, with the text."""
    split = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("w", words(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    return split.select(
        "doc_id", "text", F.size("w").cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("bigint").alias("all"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("dup"))).alias("lines"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
    ).select("*", F.col("lines.all").alias("n_lines"), F.col("lines.dup").alias("n_dup_lines")).drop("lines")


def spark_rule(name: str) -> Column:
    return F.expr(f"coalesce({RULES[name].replace(chr(92), chr(92) * 2).replace(", 'g')", ')')}, false)")


def estimates(docs: DataFrame, rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """Of each rule (share of rejections, seconds a document), measured on about ``rows`` documents: the time of a job
    that tries the rule ``TIMES`` times on each of them, less that of a job that tries it once."""
    some = staged(counts(hashed_share(docs.select("doc_id", "text"), docs.count(), rows, "doc_id")))
    found = some.agg(F.count(F.lit(1)).alias("n_rows"), *(F.sum(spark_rule(name).cast("int")).alias(name) for name in RULES)).first()
    n = max(found["n_rows"], 1)

    def seconds(name: str, times: int) -> float:
        began = time.perf_counter()
        some.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(times)))).agg(F.sum(spark_rule(name).cast("int"))).collect()
        return time.perf_counter() - began

    cost = {name: max(seconds(name, TIMES) - seconds(name, 1), 1e-6) / (TIMES - 1) / n for name in RULES}
    return {name: (((found[name] or 0) + 0.5) / n, cost[name]) for name in RULES}


def in_order(known: dict[str, tuple[float, float]]) -> list[str]:
    """Rule names by rejections per cost."""
    return sorted(known, key=lambda x: -known[x][0] / known[x][1])


def ordered_rules(docs: DataFrame, rows: int = SAMPLE_ROWS) -> list[str]:
    return in_order(estimates(docs, rows))


def quality(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the first rule that rejected (null if none)."""
    counted = counts(docs)
    names = order or ordered_rules(docs)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    verdict = F.when(F.col("base_failed"), "base")
    for name in names:
        verdict = verdict.when(spark_rule(name), name)
    return counted.withColumn("base_failed", failed).withColumn("rejected_by", verdict).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("rejected_by").isNull().alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents
), w AS (
  SELECT rid, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t
), g AS (
  SELECT rid, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS i, w FROM w WHERE len(w) >= {WINDOW}
), s AS (
  SELECT rid, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g FROM g
), d AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM s
), c AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(generate_series(i, i + {WINDOW - 1})) AS p FROM d WHERE n > 1) GROUP BY rid
), b AS (
  SELECT doc_id, text, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM t JOIN w USING (rid) LEFT JOIN c USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR {" OR ".join(f"({r})" for r in RULES.values())}) AS kept
FROM b
"""
