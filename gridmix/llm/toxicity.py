"""Toxicity of texts through a noisy-channel decoder.

Three steps, each over all rows it is meant for:

1. a character trigram model, counted over the words of all documents (a table of fixed size);
2. restoring: a token with digits or symbols between letters or with stretched letters is a lattice (each character may
   stand for itself, for the letters it imitates, or for nothing; a run may stand for one or two letters), and so is a
   run of characters set apart by blanks or marks, where between any two the words may end or not; the best path under
   the character model and the channel costs gives the restored words;
3. a logistic model over words and word beginnings of restored texts, fitted on at most ``TRAIN_ROWS`` labelled
   documents (those whose crc32(doc_id) modulo 3 is not 1), applied to whole texts.

Defined results: null and empty texts get the score of a text without features; a null doc_id is never held out and
never a training row; a doc_id with several labels counts as toxic if one says so; no labels at all give 0.5;
repeated rows give repeated results (of rows that share a doc_id one teaches, that with the least text); an empty table
gives an empty result; only doc_id and text of documents are read. Letters beyond Latin (from U+0180 on) are one symbol
of the character model: they are kept in words, but nothing is restored by their kind.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.llm.bpe import Memo
from gridmix.llm.common import hashed_share, row_slices, staged, table, text_bytes

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
#: The classifier is fitted on so many labelled documents at most, chosen by a hash of their id.
TRAIN_ROWS = 20_000
#: It uses so many words and word beginnings at most.
FEATURES = 600
MIN_DOCS = 3
PREFIXES = (4, 5, 6, 7)

# Letters that digits and symbols imitate.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y", "§": "s"}
#: Natural logs of the channel: writing an imitation, inserting a mark, inserting a mark that could be an imitation,
#: stretching a letter, hiding the end of a word between spaced characters.
IMITATE, INSERT, INSERT_LIKE, STRETCH, BREAK = -1.0, -0.5, -12.0, -1.0, -1.0
EDGE = ".,;:!?\"'()[]{}<>#$%&*|~^`=/\\_-+«»“”‘’…"
SYMBOLS = 64
#: Characters set apart by one to three blanks or marks, or imitations of letters among them.
SPELLED = re.compile(r"(?<![\w@$!|])[\w@$!|](?:[^\w@$!|\n]{1,3}[\w@$!|]){2,}(?![\w@$!|])")
#: Three equal letters, or two pairs of them.
STRETCHED = re.compile(r"(\w)\1\1|(\w)\2\w*(\w)\3")
#: Bytes turned into symbols at once.
STEP = 4 << 20
SPACED = re.compile(r"[^\w@$!|]+|_")
INNER = re.compile(r"[^\W\d_][^\w]+[^\W\d_]")


def symbol_table() -> np.ndarray:
    """Code point (to 0x17F) -> symbol: 0 for what is no letter, a-z, then the Latin letters with marks, folded to fit.
    The last entry stands for all beyond."""
    out = np.full(0x181, SYMBOLS - 1, np.uint8)
    out[:0x180] = 0
    for c in range(0x180):
        low = chr(c).lower()
        if chr(c).isalpha() and len(low) == 1:
            k = ord(low)
            out[c] = k - 96 if 97 <= k <= 122 else 27 + (k - 0xDF) % 36
    return out


SYMBOL = symbol_table()


def symbol(c: str) -> int:
    return int(SYMBOL[min(ord(c), 0x180)])


def symbols(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the characters of UTF-8 bytes, and where characters begin. Two-byte UTF-8 gives one code point at its first byte."""
    out, begin = [], (raw & 0xC0) != 0x80
    for a in range(0, len(raw), STEP):
        b = raw[a : a + STEP + 1].astype(np.uint16)
        after = np.append(b[1:], 32)[:STEP]
        b = b[:STEP]
        after = after[: len(b)]
        point = np.where(b < 0x80, b, np.where((b & 0xE0) == 0xC0, (b & 0x1F) << 6 | after & 0x3F, 0x180))
        out.append(SYMBOL[np.minimum(point, 0x180)][begin[a : a + STEP]])
    return np.concatenate(out) if out else np.zeros(0, np.uint8), begin


def padded_symbols(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Symbols of rows with two blanks before each row and two at the end, so that no trigram depends on a row's neighbours."""
    s, begin = symbols(raw)
    before = np.append(0, np.cumsum(begin))[offsets]  # characters before each row
    out = np.zeros(len(s) + 2 * len(offsets), np.uint8)
    out[np.arange(len(s)) + np.repeat(2 * np.arange(1, len(offsets)), np.diff(before))] = s
    return out


def trigram_counts(docs: DataFrame) -> DataFrame:
    """Counts of symbol trigrams over all texts; each task adds its own up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            raw, offsets = text_bytes(batch["text"])
            for a, b in row_slices(offsets, STEP):
                s = padded_symbols(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for i in range(0, len(s) - 2, STEP):
                    t = s[i : i + STEP + 2].astype(np.int32)
                    total += np.bincount(t[:-2] << 12 | t[1:-1] << 6 | t[2:], minlength=SYMBOLS**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["gram", "n"])

    return docs.select("text").mapInArrow(count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities of a symbol after two others, as one array of SYMBOLS cubed (fixed size)."""
    n = np.zeros(SYMBOLS**3)
    for gram, count in trigram_counts(docs).collect():  # at most SYMBOLS**3 rows
        n[gram] = count
    n = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    pair = n.sum(0) + 0.5
    pair /= pair.sum(1, keepdims=True)
    out = (n + 4 * pair[None]) / (n.sum(2, keepdims=True) + 4)
    return np.log(out).astype(np.float32).reshape(-1)


class Restorer:
    """Words of a text as they were meant; ``model`` is what ``character_model`` gives."""

    def __init__(self, model: np.ndarray):
        self.log = model.tolist()

    def steps(self, c: str, n: int) -> list[tuple[str, float]]:
        """What n equal characters may stand for, and the channel's cost of each."""
        out: list[tuple[str, float]] = []
        if c.isalpha():
            out.append((c * min(n, 2), STRETCH * (n > 2)))
            if n > 1:
                out.append((c, STRETCH))
        else:
            out.append(("", INSERT_LIKE if c in LEET else INSERT))
            for to in LEET.get(c, ""):
                out.append((to * min(n, 2), IMITATE))
                if n > 1:
                    out.append((to, IMITATE + STRETCH))
        return out

    def best(self, runs: list[tuple[str, int]], spaced: bool = False) -> tuple[float, str]:
        """Viterbi over the lattice of (character, how many) runs; a state is the last two symbols. Between spaced
        characters a word may end: the path takes a blank. Score and text of the best path."""
        log = self.log
        best: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        for i, (c, n) in enumerate(runs):
            if spaced and i:
                cut: dict[tuple[int, int], tuple[float, str]] = {}
                for (a, b), (score, text) in best.items():
                    s = score + BREAK + log[a << 12 | b << 6]
                    if b and ((b, 0) not in cut or s > cut[b, 0][0]):
                        cut[b, 0] = (s, text + " ")
                best = {**best, **cut}  # no state of a path within a word ends with a blank, but for the start
            after: dict[tuple[int, int], tuple[float, str]] = {}
            steps = self.steps(c, n)
            for (a, b), (score, text) in best.items():
                for put, cost in steps:
                    x, y, s = a, b, score + cost
                    for ch in put:
                        z = symbol(ch)
                        s += log[x << 12 | y << 6 | z]
                        x, y = y, z
                    if (x, y) not in after or s > after[x, y][0]:
                        after[x, y] = (s, text + put)
            best = after
        return max(((s + log[a << 12 | b << 6], w) for (a, b), (s, w) in best.items()), default=(0.0, ""))

    def decode(self, token: str) -> str:
        """The restored word of a token."""
        return self.best([(m[1], len(m[0])) for m in re.finditer(r"(.)\1*", token, re.DOTALL)])[1]

    def spelled(self, run: str) -> list[str]:
        """The restored words of spaced characters, given without what sets them apart."""
        return self.best([(c, 1) for c in run], True)[1].split()

    def words(self, token: str) -> list[str]:
        """The word in a lower-case token, and its restored form where the token looks written over."""
        core = token.strip(EDGE)
        out = [core] if core.isalpha() else []
        odd = not out and any(c.isalpha() for c in token) and (any(c in LEET for c in token.rstrip(EDGE)) or INNER.search(core))
        if odd or (out and STRETCHED.search(core)):
            out.append(self.decode(token.rstrip(EDGE) if odd else core))
        elif not out and core:
            out.append("".join(c for c in core if c.isalpha()))
        if odd and not core.isalpha() and token.rstrip(EDGE) != token and any(c in LEET for c in token):
            out.append(self.decode(token))
        return [w for w in out if len(w) > 1]


def features(words: list[str]) -> list[str]:
    return [*words, *(f"{w[:k]}*" for w in words for k in PREFIXES if len(w) >= k)]


class Reader:
    """Feature sets of texts; ``pick`` says what stands for a feature (None: it is left out)."""

    def __init__(self, model: np.ndarray, pick, memo: int = 400_000):
        self.restorer, self.pick = Restorer(model), pick
        self.memo = Memo(self.of_token, memo)

    def of_token(self, token: str) -> tuple:
        return tuple({p for f in features(self.restorer.words(token)) if (p := self.pick(f)) is not None})

    def __call__(self, text: str | None) -> set:
        if not text:
            return set()
        low = text.lower()
        found = set().union(*map(self.memo.__getitem__, set(low.split())))
        for m in SPELLED.finditer(low):
            run = SPACED.sub("", m[0])
            for a in range(3):  # the run may begin and end with words of one letter
                for b in range(2):
                    for word in self.restorer.spelled(run[a : len(run) - b]):
                        if len(word) > 2:
                            found.update(self.memo[word])
        return found


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(doc_id.cast("string")) % n


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic) of the labelled documents to learn from: ``rows`` at most, by a hash of their id."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = hashed_share(known, known.count(), rows * 97 // 100, "doc_id")  # a share by hash varies a little
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    own = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return own.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25, chunk: int = 2000) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the last column of x is all ones, for the bias.

    x stays in single precision; sums are made of chunks of rows in double precision.
    """
    w, keep = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    keep[-1] = 1e-3
    for _ in range(rounds):
        curve, slope = np.diag(keep), -keep * w
        for a in range(0, len(x), chunk):
            part = x[a : a + chunk].astype(np.float64)
            p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
            curve += part.T @ (part * (p * (1 - p))[:, None])
            slope += part.T @ (y[a : a + chunk] - p)
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, model: np.ndarray, rows: int = TRAIN_ROWS) -> tuple[dict[str, float], float]:
    """Weights by feature, and the bias. The driver gets FEATURES feature names and TRAIN_ROWS short lists of numbers."""
    train = training_rows(docs, labels, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(model, lambda f: f)
        for batch in batches:
            found = [sorted(read(t)) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["toxic"], pa.array(found, pa.list_(pa.string()))], ["toxic", "found"])

    seen = staged(train.mapInArrow(run, "toxic int, found array<string>"))
    size = seen.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).first()
    n, t = size["n"], size["t"] or 0
    if not n or not 0 < t < n:
        return {}, 0.0 if not n else (4.0 if t else -4.0)
    by = seen.select("toxic", F.explode("found").alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).where(F.col("n") >= MIN_DOCS)
    expected = F.col("n") * F.lit(t / n)
    z = (F.col("t") - expected) / F.sqrt(expected * F.lit(1 - t / n) + F.lit(0.5))
    names = [r["feature"] for r in by.orderBy(F.abs(z).desc(), "feature").limit(FEATURES).select("feature").collect()]
    place = {f: i for i, f in enumerate(names)}
    picked = F.array_sort(F.array_intersect("found", F.array(*map(F.lit, names)).cast("array<string>")))
    rows_found = sorted(seen.select("found", "toxic").withColumn("found", picked).collect())  # ``rows`` at most
    x, y = np.zeros((len(rows_found), len(names) + 1), np.float32), np.array([r["toxic"] for r in rows_found], float)
    x[:, -1] = 1
    for i, r in enumerate(rows_found):
        x[i, [place[f] for f in r["found"]]] = 1
    w = fit_logistic(x, y)
    return dict(zip(names, w[:-1].tolist())), float(w[-1])


class Scorer:
    """Scores of batches of texts; made on the driver, with what it knows, and used in the tasks."""

    def __init__(self, docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS):
        self.model = character_model(docs)
        self.weights, self.bias = learn(docs, labels, self.model, rows)

    def reader(self) -> Reader:
        return Reader(self.model, lambda f: f if f in self.weights else None)

    def scores(self, read: Reader, batch: pa.RecordBatch) -> list[float]:
        z = [self.bias + sum(map(self.weights.__getitem__, sorted(read(t)))) for t in batch["text"].to_pylist()]
        return [1 / (1 + math.exp(-max(-30.0, min(30.0, v)))) for v in z]


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    scorer = Scorer(docs, labels, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = scorer.reader()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scorer.scores(read, batch), pa.float64())], ["doc_id", "score"])

    use = docs.select("doc_id", "text")
    scored = use.mapInArrow(run, f"doc_id {use.schema['doc_id'].dataType.simpleString()}, score double")
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of docs, with all columns and no other, whose score is below the threshold."""
    scorer = Scorer(docs, labels, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = scorer.reader()
        for batch in batches:
            yield batch.filter(pa.array([s < THRESHOLD for s in scorer.scores(read, batch)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
