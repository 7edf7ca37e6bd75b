"""Byte-pair merging with a heap over a linked list of symbols, for vocabulary files of the tokenizers library.

``MergeCounter.count(text)`` is the number of tokens of a text: for every pre-token the initial symbols minus the
merges made. No identifiers are produced. Pre-tokens already seen are answered from a dictionary of bounded size.
"""

from __future__ import annotations

import json
import re
from heapq import heapify, heappop, heappush

# The byte alphabet and split pattern of byte-level BPE vocabularies, stated by the file format.
PRINTABLE = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
SPLIT = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_names() -> list[str]:
    """The character that stands for each byte in the vocabulary file."""
    spare = iter(range(256, 512))
    return [chr(b if b in PRINTABLE else next(spare)) for b in range(256)]


class Memo(dict):
    """Answers of ``f`` by pre-token; emptied when it holds ``limit`` entries, and never holds long ones."""

    def __init__(self, f, limit: int):
        super().__init__()
        self.f, self.limit = f, limit

    def __missing__(self, piece: str):
        out = self.f(piece)
        if len(piece) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = out
        return out


class MergeCounter:
    """Counts tokens of texts under a byte-level BPE ``.json`` vocabulary; ``memo`` bounds the remembered pre-tokens."""

    def __init__(self, path: str, memo: int = 600_000):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        self.start = [ids[c] for c in byte_names()]
        self.rank: dict[int, tuple[int, int]] = {}
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[ids[a] << 24 | ids[b]] = (r, ids[a + b])
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.split = regex.compile(SPLIT).findall
        self.memo = Memo(self.merged, memo)

    def merged(self, piece: str) -> int:
        """Tokens of one pre-token: symbols at first, less one for each merge of the lowest-ranked adjacent pair."""
        rank = self.rank
        sym = [self.start[b] for b in piece.encode("utf-8", "surrogatepass")]
        n = left = len(sym)
        heap = []
        for i in range(n - 1):
            if found := rank.get(sym[i] << 24 | sym[i + 1]):
                heap.append((found[0], i, found[1], sym[i], sym[i + 1]))
        if not heap:
            return n
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            _, i, new, a, b = heappop(heap)
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue  # one side has been merged away meanwhile
            sym[i], sym[j] = new, -1
            after[i] = k = after[j]
            left -= 1
            if k < n:
                before[k] = i
                if found := rank.get(new << 24 | sym[k]):
                    heappush(heap, (found[0], i, found[1], new, sym[k]))
            if (h := before[i]) >= 0 and (found := rank.get(sym[h] << 24 | new)):
                heappush(heap, (found[0], h, found[1], sym[h], new))
        return left

    def count(self, text: str | None) -> int:
        """Tokens of a text; null counts as empty. A special token's string in the text is one token."""
        if not text:
            return 0
        if self.cut is None or not any(s in text for s in self.special):
            return sum(map(self.memo.__getitem__, self.split(text)))
        parts = self.cut.split(text)
        return len(parts) - 1 + sum(sum(map(self.memo.__getitem__, self.split(p))) for p in parts)
