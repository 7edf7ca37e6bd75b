"""Secrets in texts: three stated patterns, and random strings found by their token efficiency.

Text in a language needs few tokens: a vocabulary learnt from text covers several characters with each token. A
random string has no such tokens, so its characters per token are low. Candidates are long runs of letters, digits
and base64 punctuation; known digests (hexadecimal of a digest's length), UUIDs and identifiers made of words (parts in
camel, snake or kebab case that take few tokens) are excluded before the ratio is taken.

Defined results: null and empty texts have no secrets; texts are scanned whole; spans are in code points, end
exclusive; repeated rows give repeated results; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.llm.common import by_batch, table

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "random")

#: A candidate is a whole run of these characters, of this length or more.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+")
LONG_HEX = re.compile(r"[0-9a-f]{24,}+")  # of 24 or more, as the base pattern asks
KEYWORDS = ("passw", "secret", "token", "api_key", "apikey")
#: Hexadecimal lengths of CRC-64, MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST = re.compile(r"(?i:[0-9a-f]{16}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})")
UUID = re.compile(r"(?i:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})")
WORDY = re.compile(r"[A-Za-z]*[0-9]{0,6}")
HUMP = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Letters per token from which the parts of a run are words. (The two-letter humps of random mixed case are below.)
WORD_RATIO = 3.0
#: Characters per token below which a candidate counts as random.
RATIO = 2.0
VOCABULARY = "byte_bpe_50k.tiktoken"
_encodings: dict[str, object] = {}


def encoding(path: str):
    """The tiktoken encoding of a file of ranks, once per worker process."""
    if path not in _encodings:
        import base64

        import tiktoken

        from gridmix.llm.bpe import SPLIT

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def is_known(run: str, enc) -> bool:
    """A digest, a UUID, or an identifier: parts between punctuation and at capitals that are words, by their letters
    per token, with at most a number behind."""
    if DIGEST.fullmatch(run) or UUID.fullmatch(run):
        return True
    if not all(WORDY.fullmatch(p) for p in re.split(r"[+/_=-]+", run)):
        return False
    humps = HUMP.findall(run)
    return sum(map(len, humps)) >= WORD_RATIO * sum(len(enc.encode_ordinary(h)) for h in humps)


def spans(text: str, enc, ratio: float = RATIO) -> list[tuple[int, int, int]]:
    """(start, kind index, end) in order of start, then kind."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    out.sort()
    starts, ends = [s for s, _, _ in out], list(accumulate((e for _, _, e in out), max))
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        before = bisect_left(starts, b)  # of the base spans that start before b, does the last end reach over a?
        if not (before and ends[before - 1] > a) and not is_known(m[0], enc) and len(m[0]) < ratio * len(enc.encode_ordinary(m[0])):
            out.append((a, 3, b))
    return sorted(out)


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def find_secrets(docs: DataFrame, path: str, ratio: float = RATIO) -> DataFrame:
    """Per row: doc_id, counts of the base kinds, base_sha256, spans, and n_random."""

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoding(path)
        cols: list[list] = [[] for _ in range(6)]
        for text in batch["text"].to_pylist():
            found = spans(text, enc, ratio) if text else []
            n = [sum(k == kind for _, k, _ in found) for kind in range(4)]
            digest = hashlib.sha256(joined([x for x in found if x[1] < 3]).encode()).hexdigest()
            for c, v in zip(cols, (*n[:3], digest, joined(found), n[3])):
                c.append(v)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([batch["doc_id"], *map(pa.array, cols, kinds)], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])

    docs = docs.select("doc_id", "text")
    return by_batch(docs, scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")


def masked(text: str, found: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with every span, merged where they overlap, replaced by a mark."""
    out, at = [], 0
    for a, _, b in found:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask_secrets(docs: DataFrame, path: str, ratio: float = RATIO) -> DataFrame:
    """The same rows and columns with all secrets masked in text and n_chars, where there is one, counted anew."""

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path)
        for batch in batches:
            texts = [t and masked(t, spans(t, enc, ratio)) for t in batch["text"].to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, batch["text"].type))

    out = docs.mapInArrow(mask, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return find_secrets(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
