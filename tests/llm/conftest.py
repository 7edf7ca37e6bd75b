import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(texts, first=0):
    return [(first + i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]


def words(rng, n, of=400):
    return " ".join(f"w{rng.randrange(of)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and very long texts, ties and repeated rows, other scripts, white space of all kinds."""
    rng = random.Random(5)
    long = words(rng, 30_000)
    same = words(rng, 120)
    near = same.split()
    near[60] = "changed"
    return [
        None, "", " \t\n\x0b\x0c\r", "one", "two words", "a b c d", same, same, " ".join(near), same.upper(), long, long[:5000] + " x " + long[5000:9000],
        "naïve café — 東京 🙂   Ünïcode   sp", "line\nline\nline\r\nline\n\n", "x" * 50_000, "ab" * 400, "<|endoftext|> token <|endoftext|>", words(rng, 7), "\u0000 nul", "don't I'll 12345 $$$ ***",
    ]


@pytest.fixture(scope="session")
def docs(spark, odd_texts):
    rows = rows_of(odd_texts)
    rows += [rows[7], (None, "no id at all, some words here", "en", "s", 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "text")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sf(name="sf0.001"):
    return f"/root/testdata/{name}"
