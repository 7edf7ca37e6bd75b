"""Random strings of letters only are secrets; identifiers made of words are not."""

import random
import string

import public_tokenizers
import pytest

from gridmix.llm import secrets


@pytest.mark.parametrize("letters", [string.ascii_lowercase, string.ascii_uppercase, string.ascii_letters])
def test_random_letters_are_found(letters):
    enc, rng = secrets.encoding(public_tokenizers.path(secrets.VOCABULARY)), random.Random(17)
    keys = ["".join(rng.choice(letters) for _ in range(32)) for _ in range(300)]
    found = [secrets.spans(f"the key is {k} here", enc) for k in keys]
    assert sum(f == [(11, 3, 43)] for f in found) >= 285
    assert secrets.spans("see " + "+".join(k[:8] for k in keys[:4]), enc)


def test_identifiers_are_left():
    enc = secrets.encoding(public_tokenizers.path(secrets.VOCABULARY))
    for name in ("getResponseStatusCodeFromServer", "user_name_to_account_id_map", "some-long-file-name-with-words-2024", "internationalization", "MAX_NUMBER_OF_CONNECTIONS", "-" * 40, "parseHTMLDocumentFragment"):
        assert secrets.spans(f"call {name} now", enc) == [], name


ALPHABETS = [string.ascii_letters + string.digits, string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "_-"]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_recall_on_planted_strings(alphabet):
    enc, rng = secrets.encoding(public_tokenizers.path(secrets.VOCABULARY)), random.Random(23)
    for size in (20, 24, 32, 40, 64):
        keys = ["".join(rng.choice(alphabet) for _ in range(size)) for _ in range(200)]
        found = sum(any(k == 3 for _, k, _ in secrets.spans(f"it is {x} there", enc)) or bool(secrets.LONG_HEX.search(x)) for x in keys)
        assert found >= 180, (size, found)


def test_few_false_positives(spark):
    """Only runs that the base patterns leave can be false; in invented prose without other secrets there are none."""
    enc = secrets.encoding(public_tokenizers.path(secrets.VOCABULARY))
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    runs = [m[0] for t, in d for m in secrets.CANDIDATE.finditer(t or "")]
    extra = sum(k == 3 for t, in d for _, k, _ in secrets.spans(t or "", enc))
    assert extra <= 0.1 * max(len(runs), 10), (extra, len(runs))


def test_time_is_linear_in_keys():
    import time

    enc = secrets.encoding(public_tokenizers.path(secrets.VOCABULARY))
    text = "secret=abcdefgh Zx81kQ9vB2mW7rT4yU6pL0 " * 60_000
    began = time.perf_counter()
    assert len(secrets.spans(text, enc)) == 120_000
    assert time.perf_counter() - began < 60


def plain_spans(text, enc):
    """The same rules with every candidate compared with every base span."""
    base = [x for x in secrets.spans(text, enc) if x[1] < 3]
    out = list(base)
    for m in secrets.CANDIDATE.finditer(text):
        a, b = m.span()
        if all(e <= a or s >= b for s, _, e in base) and not secrets.is_known(m[0], enc) and len(m[0]) < secrets.RATIO * len(enc.encode_ordinary(m[0])):
            out.append((a, 3, b))
    return sorted(out)


def test_overlaps_by_brute_force():
    enc, rng = secrets.encoding(public_tokenizers.path(secrets.VOCABULARY)), random.Random(29)
    parts = ["secret=", "token: ", "AKIA", "0123456789abcdef" * 2, "Zx81kQ9vB2mW7rT4yU6pL0", " ", ".", "words ", "hQ7-xLw_03kPzR9", "="]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(30)))
        assert secrets.spans(text, enc) == plain_spans(text, enc)
