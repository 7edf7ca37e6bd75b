"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is coded byte by byte, with an end symbol. After each byte, and after each of the ``CODES`` most frequent pairs of
bytes, stands a prefix code of its own, built from what follows there in the training texts, so a byte is a few bits. For every bit, each context
(the last two bytes, the last four, the word so far) looks up, in a hashed table, how often the bit was 0 and 1 after it
in the training texts. The log odds are mixed by weights that a gate selects (the bit's depth in the code, and how sure
the four-byte context is), and squashed. The weights start from what the training texts teach and are refined online,
block after block of a text, by the gradient of the coding cost. The score is minus the total cost in bits, as a log10
probability.

Training counts cover all texts whose crc32(doc_id as text) modulo 10 is not 0. Starting weights are fitted on a share
of them, one in ``TUNING`` by a hash of the id, under the counts of all others: Newton steps on sums over that share,
so they don't depend on partitions. Then the share's own counts are added. Tables grow with the training bytes up to
``MOST_BITS``; the driver receives them finished, and sends them to the tasks. The base score is a unigram model over
words: counts are grouped over all training texts; the ``COMMON`` most frequent words are sent to the tasks, the counts
of all others are joined by word.

Defined results: null and empty texts have one token, the end; a null doc_id counts as training (its remainder is not
0); repeated rows count as often as they occur; a text of more than ``PIECE`` bytes is worked on in pieces of that many,
each with the contexts and weights that the one before left, so pieces don't show in the result; an empty table gives an empty result; no training texts at all give
c = N = V = 0 and even odds for every bit; only doc_id and text are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.llm.common import row_slices, staged, table, text_bytes

FOLDS, HELD_OUT = 10, 0
#: One training text in so many teaches the starting weights.
TUNING = 64
#: A context's table has 2**b slots: the training bytes as a power of two, less this, within these bounds.
LESS_BITS, LEAST_BITS, MOST_BITS = (8, 6, 6), (16, 18, 18), (20, 22, 22)
CHUNK = 1 << 12
END = 256
ALPHABET = END + 1
#: Words sent to every task with their counts.
COMMON = 100_000
#: The weights of a text are refined after FIRST bytes, twice that, and so on, and from BLOCK bytes on after every BLOCK.
FIRST, BLOCK = 64, 1024
#: The weights' start where nothing was learnt, and the step of a refinement.
START, STEP = 0.45, 0.0008
ROUNDS, RIDGE = 4, 1e-3
SCALE = 12.0
SPREAD = np.uint32(0x2C1B3C6D)
#: Bytes worked on at once (so that arrays stay in the processor's cache), and the most that one text may bring: a
#: multiple of BLOCK, so that pieces end where blocks do.
SLICE, PIECE = 96 << 10, 256 << 10
#: Pairs of symbols with a code of their own.
CODES = 256
DEPTHS = 4
#: Log odds, in steps of 1 / SCALE, from which the four-byte context counts as weak, fair, sure.
SURE = (3, 20, 48)
GATES = DEPTHS * (len(SURE) + 1)
FOUR = 1  # the place of the four-byte context among the contexts


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def code_paths(weights: list[float]) -> list[list[tuple[int, int]]]:
    """Huffman: for each symbol its (inner node, bit) pairs from the root."""
    heap = [(w, s) for s, w in enumerate(weights)]
    heapq.heapify(heap)
    children: dict[int, tuple[int, int]] = {}
    node = len(weights)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        children[node] = (a[1], b[1])
        heapq.heappush(heap, (a[0] + b[0], node))
        node += 1
    paths: list[list[tuple[int, int]]] = [[]] * len(weights)
    stack: list[tuple[int, list]] = [(node - 1, [])]
    while stack:
        at, path = stack.pop()
        if at in children:
            stack += [(to, [*path, (at - len(weights), bit)]) for bit, to in enumerate(children[at])]
        else:
            paths[at] = path
    return paths


class Code:
    """Prefix codes of symbols by the two before them, flattened: the bits of symbol s after state t (the last symbol
    times ALPHABET, and the one before it) are entries first..first+size at row[t] + s.

    ``pairs`` counts symbols by the symbol before them, ``frequent`` by some states. A state not among these has the
    code of its last symbol, and symbols after which nothing was counted share one code.
    """

    def __init__(self, pairs: np.ndarray, frequent: dict[int, np.ndarray] | None = None):
        pairs = np.asarray(pairs, float).reshape(ALPHABET, ALPHABET)
        prior = (pairs.sum(0) + 1) / (pairs.sum() + ALPHABET)
        known, frequent = np.flatnonzero(pairs.any(1)), frequent or {}
        row = np.zeros((ALPHABET, ALPHABET), np.int64)
        row[known] = np.arange(1, len(known) + 1)[:, None]
        row.reshape(-1)[list(frequent)] = np.arange(len(known) + 1, len(known) + 1 + len(frequent))
        size, nodes, bits, depth = [], [], [], []
        for k, own in enumerate([np.zeros(ALPHABET), *pairs[known], *frequent.values()]):
            paths = code_paths((own + prior).tolist())
            size += map(len, paths)
            flat = np.array([x for path in paths for x in path], np.int64).reshape(-1, 2)
            nodes.append(k * ALPHABET + flat[:, 0])
            bits.append(flat[:, 1])
            depth += [min(d, DEPTHS - 1) for path in paths for d in range(len(path))]
        self.row = row.reshape(-1) * ALPHABET
        self.size = np.array(size, np.int64)
        self.first = np.cumsum(self.size) - self.size
        salt = (np.concatenate(nodes).astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
        salt = (salt ^ salt >> np.uint32(15)) * SPREAD
        # One number an entry, so that one look-up serves: the node's salt, the depth's first gate, the bit.
        self.packed = salt.astype(np.int64) << 8 | np.array(depth) * (GATES // DEPTHS) << 1 | np.concatenate(bits)

    def unpacked(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Salts, first gates and bits of entries."""
        x = self.packed.take(entry)
        return (x >> 8).astype(np.uint32), x >> 1 & 127, x & 1

    def entries(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of the symbol, entry) for every bit of these symbols, in order."""
        code = self.row.take(states)
        code += symbols
        size = self.size.take(code)
        at = np.repeat(np.arange(len(symbols)), size)  # indices stay 64 bits wide: numpy widens all others at each use
        shift = self.first.take(code) - (np.cumsum(size) - size)
        entry = shift.take(at)
        entry += np.arange(len(at))
        return at, entry


class Carry:
    """What a piece of a text leaves to the next one: its place, the last four symbols, the word so far (its hash, and
    the power that its next symbol takes), and what the weights have gained."""

    def __init__(self) -> None:
        self.place, self.tail, self.word, self.power = 0, np.full(4, END, np.uint32), 0, 1
        self.more: np.ndarray | None = None


def text_pieces(raw: np.ndarray, offsets: np.ndarray, most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Carry | None]]:
    """(row of each piece, bytes, offsets, whether the text ends there, its carry) of slices. Only texts of more than
    PIECE bytes have several pieces, and a carry, which ``contexts`` and ``Mixer.cost`` read and bring up to date."""
    for a, b in row_slices(offsets, most or SLICE):
        own, size = raw[offsets[a] : offsets[b]], int(offsets[b] - offsets[a])
        if b - a > 1 or size <= PIECE:
            yield np.arange(a, b), own, offsets[a : b + 1] - offsets[a], np.ones(b - a, bool), None
            continue
        carry = Carry()
        for at in range(0, size, PIECE):
            part = own[at : at + PIECE]
            carry.place = at
            yield np.array([a]), part, np.array([0, len(part)]), np.array([at + PIECE >= size]), carry


def symbols_of(raw: np.ndarray, offsets: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the pieces with an end symbol where a text ends, and the pieces' new offsets."""
    added = np.append(0, np.cumsum(ends))
    out = np.full(len(raw) + added[-1], END, np.int64)
    fill = np.ones(len(out), bool)
    fill[(offsets[1:] + added[:-1])[ends]] = False
    out[fill] = raw
    return out, offsets + added


def before(s: np.ndarray, offsets: np.ndarray, j: int, carry: Carry | None) -> np.ndarray:
    """The symbol j places before each position. Before its first symbol a text has end symbols, and a later piece what
    its carry says."""
    out = np.full(len(s), END, s.dtype)
    out[j:] = s[: max(0, len(s) - j)]
    for k in range(j):
        first = offsets[:-1] + k
        out[first[first < len(s)]] = END
    if carry:
        out[:j] = carry.tail[4 - j :][: len(s)]
    return out


def contexts(symbols: np.ndarray, offsets: np.ndarray, carry: Carry | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """The code's state at each position, and a 32-bit hash of each context there, spread like the salts of a code."""
    s = symbols.astype(np.uint32)
    b1, b2, b3, b4 = (before(s, offsets, j, carry) for j in (1, 2, 3, 4))
    state = b1 * np.uint32(ALPHABET) + b2
    two = state * np.uint32(0x85EBCA6B)
    four = (two ^ (b3 * np.uint32(257) + b4) * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)
    # The word so far: prefix sums of powers from the last blank, end symbol or piece's start on.
    blank = (s <= 32) | (s == END)
    up, down = _powers(len(s) + 1)
    sums = np.concatenate([np.zeros(1, np.uint32), np.cumsum((s + np.uint32(1)) * up[: len(s)], dtype=np.uint32)])
    at = np.arange(len(s))
    head = np.concatenate([[True], blank[:-1]])
    head[offsets[:-1][offsets[:-1] < len(s)]] = True
    start = np.maximum.accumulate(np.where(head, at, 0))
    word = (sums[at] - sums[start]) * down[start]
    if carry:
        goes_on = start == 0
        word[goes_on] = word[goes_on] * np.uint32(carry.power) + np.uint32(carry.word)
        first = start[-1] if len(s) and not blank[-1] else len(s)  # of the word that the next piece goes on with
        with np.errstate(over="ignore"):
            own, power = int((sums[-1] - sums[first]) * down[first]), int(up[len(s) - first])
        low = (1 << 32) - 1
        carry.word, carry.power = (carry.word + carry.power * own & low, carry.power * power & low) if first == 0 else (own, power)
        carry.tail = np.append(carry.tail, s)[-4:]
    word += np.uint32(0x165667B1)
    return state.astype(np.int64), [(h ^ h >> np.uint32(13)) * SPREAD for h in (two, four, word * np.uint32(0x85EBCA77))]


_cache: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _cache or len(_cache["p"][0]) < n:
        base = 0x01000193
        make = lambda b: np.cumprod(np.append(np.ones(1, np.uint32), np.full(n, b, np.uint32)), dtype=np.uint32)
        _cache["p"] = (make(base), make(pow(base, -1, 1 << 32)))
    return _cache["p"]


def slot(context: np.ndarray, at: np.ndarray, salt: np.ndarray, bits: int) -> np.ndarray:
    """Table slots of the contexts at some positions."""
    h = context.take(at)
    h += salt
    h >>= np.uint32(32 - bits)
    return h.astype(np.int64)


def words_of(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(row, word) of all words of a column, A-Z lower-cased."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text.fill_null("")))
    words, row = lists.flatten(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    some = pc.greater(pc.binary_length(words), 0)  # blanks around a text leave empty strings
    return row[some.to_numpy(zero_copy_only=False)], words.filter(some).cast(pa.binary())


def first_pass(train: DataFrame) -> DataFrame:
    """(word, triple, n): counts of words (triple null; the end token is the word that is empty) and of symbols after
    states (state * ALPHABET + symbol)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triples, rows = np.zeros(ALPHABET**3, np.int32), 0  # of one task's texts
        names, held, size = ["word", "triple", "n"], [], 0

        def added() -> pa.Table:
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        def out(t: pa.Table) -> Iterator[pa.RecordBatch]:
            for b in t.append_column("triple", pa.nulls(t.num_rows, pa.int32())).select(names).to_batches():
                yield b

        for batch in batches:
            raw, offsets = text_bytes(batch["text"])
            for _, part, at, ends, carry in text_pieces(raw, offsets, 1 << 20):
                symbols, own = symbols_of(part, at, ends)
                state = before(symbols, own, 1, carry) * ALPHABET + before(symbols, own, 2, carry)
                np.add.at(triples, state * ALPHABET + symbols, np.int32(1))
                if carry:
                    carry.tail = np.append(carry.tail, symbols)[-4:]
            rows += batch.num_rows
            for a in range(0, batch.num_rows, 200):
                seen = pc.value_counts(words_of(batch["text"].slice(a, 200))[1])
                held.append(pa.table({"word": seen.field("values"), "n": seen.field("counts")}))
                size += len(seen)
                if size > 300_000:
                    held = [added()]
                    size = held[0].num_rows
                    if size > 200_000:
                        yield from out(held[0])
                        held, size = [], 0
        if rows:
            held.append(pa.table({"word": pa.array([b""], pa.binary()), "n": pa.array([rows], pa.int64())}))
            yield from out(added())
            used = np.flatnonzero(triples)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(used), pa.binary()), pa.array(used.astype(np.int32)), pa.array(triples[used].astype(np.int64))], names)

    return train.select("text").mapInArrow(run, "word binary, triple int, n long").groupBy("word", "triple").agg(F.sum("n").alias("n"))


def fitted_code(triples: DataFrame, codes: int = 0) -> tuple[Code, int]:
    """The code for lines (triple, n), with codes of their own for the most frequent states (CODES of them unless
    stated), and how many symbols were counted."""
    state, symbol = F.expr(f"triple div {ALPHABET}"), F.col("triple") % ALPHABET
    pairs = np.zeros((ALPHABET, ALPHABET), np.int64)
    for last, s, n in triples.groupBy(F.expr(f"triple div {ALPHABET**2}"), symbol).agg(F.sum("n")).collect():  # 257 * 257 rows at most
        pairs[last, s] = n
    counted = triples.groupBy(state.alias("state")).agg(F.sum("n").alias("n"))
    top = [r["state"] for r in counted.orderBy(F.desc("n"), "state").limit(codes or CODES).collect()]
    frequent = {t: np.zeros(ALPHABET) for t in top}
    for t, s, n in triples.where(state.isin(top)).select(state, symbol, "n").collect():  # 257 rows a state at most
        frequent[t][s] = n
    return Code(pairs, frequent), int(pairs.sum())


def table_bits(n_bytes: int) -> tuple[int, ...]:
    """Sizes of the tables for so many training bytes, as powers of two."""
    grown = max(n_bytes, 1).bit_length()
    return tuple(min(most, max(least, grown - less)) for less, least, most in zip(LESS_BITS, LEAST_BITS, MOST_BITS))


def log_odds(counts: np.ndarray) -> np.ndarray:
    """Log odds of pairs (zeros, ones) in steps of 1 / SCALE, as int8."""
    n = counts.reshape(-1, 2).astype(np.float64)
    return np.clip(np.rint(np.log((n[:, 1] + 0.35) / (n[:, 0] + 0.35)) * SCALE), -127, 127).astype(np.int8)


def context_tables(main: DataFrame, tuning: DataFrame, code: Code, bits: tuple[int, ...]) -> list[list[np.ndarray]]:
    """For each context its table of log odds, from the main texts alone and from all."""
    import zstandard

    code_sent = main.sparkSession.sparkContext.broadcast(code)

    def count(part: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own_code = code_sent.value
            total = [np.zeros(2 << b, np.int32) for b in bits]
            for batch in batches:
                raw, offsets = text_bytes(batch["text"])
                for _, own, at, ends, carry in text_pieces(raw, offsets):
                    symbols, starts = symbols_of(own, at, ends)
                    states, hashes = contexts(symbols, starts, carry)
                    where, entry = own_code.entries(states, symbols)
                    salt, _, bit = own_code.unpacked(entry)
                    for t, h, b in zip(total, hashes, bits):
                        place = slot(h, where, salt, b)
                        place <<= 1
                        place |= bit
                        np.add.at(t, place, np.int32(1))
            squeeze = zstandard.ZstdCompressor(level=1).compress
            for k, t in enumerate(total):
                parts = t.reshape(-1, 2 * CHUNK)
                used = np.flatnonzero(parts.any(1))
                if len(used):
                    yield pa.RecordBatch.from_arrays([pa.array(used + (k << 24)), pa.array([part] * len(used), pa.int32()), pa.array([squeeze(parts[c].tobytes()) for c in used], pa.binary())], ["chunk", "part", "counts"])

        return run

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: list[dict[int, np.ndarray]] = [{}, {}]  # this task's chunks, a fixed number
        open_ = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for chunk, part, counts in zip(*(batch[c].to_pylist() for c in ("chunk", "part", "counts"))):
                own, total = np.frombuffer(open_(counts), np.int32), totals[part]
                total[chunk] = total[chunk] + own if chunk in total else own.astype(np.int64)
        chunks = sorted(totals[0].keys() | totals[1].keys())
        zero = np.zeros(2 * CHUNK, np.int64)
        alone = [log_odds(totals[0].get(c, zero)).tobytes() for c in chunks]
        both = [log_odds(totals[0].get(c, zero) + totals[1].get(c, zero)).tobytes() for c in chunks]
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(alone, pa.binary()), pa.array(both, pa.binary())], ["chunk", "alone", "both"])

    kind = "chunk long, part int, counts binary"
    counted = main.select("text").mapInArrow(count(0), kind).unionByName(tuning.select("text").mapInArrow(count(1), kind))
    out = [[np.zeros(1 << b, np.int8) for b in bits] for _ in range(2)]
    done = counted.repartition("chunk").mapInArrow(add, "chunk long, alone binary, both binary")
    for chunk, *odds in done.collect():  # the finished tables, twice: 2 * sum(2**b for b in bits) bytes
        a = (chunk & 0xFFFFFF) * CHUNK
        for tables, own in zip(out, odds):
            tables[chunk >> 24][a : a + CHUNK] = np.frombuffer(own, np.int8)
    return out


def block_edges(first: int, n: int) -> np.ndarray:
    """The limits of n blocks of a text from block ``first`` on: 0, FIRST, twice that and so on to BLOCK, then every BLOCK."""
    small = [0, *(FIRST << i for i in range((BLOCK // FIRST).bit_length()))]
    at = np.arange(first, first + n + 1)
    return np.where(at < len(small), np.take(small, at, mode="clip"), (at - len(small) + 2) * BLOCK)


def block_of(place: np.ndarray) -> np.ndarray:
    """The number of the block that a place of a text lies in."""
    small = block_edges(0, (BLOCK // FIRST).bit_length())
    return np.where(place < BLOCK, np.searchsorted(small, place, side="right") - 1, len(small) - 2 + place // BLOCK)


def start_weights() -> np.ndarray:
    """Weights by (context, gate) where nothing was learnt."""
    return np.full((len(MOST_BITS), GATES), START / SCALE)


class Mixer:
    """Scores texts under a code, its context tables, and starting weights by (context, gate)."""

    def __init__(self, code: Code, tables: list[np.ndarray], weights: np.ndarray):
        self.code, self.tables, self.weights = code, tables, weights.astype(np.float32)
        self.bits = [len(t).bit_length() - 1 for t in tables]

    def bits_of(self, symbols: np.ndarray, offsets: np.ndarray, order: np.ndarray, carry: Carry | None = None) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """(symbol's place in order, gate, log odds by context towards the bit that comes, their mix) of every bit of the symbols in an order."""
        states, hashes = contexts(symbols, offsets, carry)
        states, symbols = states.take(order), symbols.take(order)
        at, entry = self.code.entries(states, symbols)
        salt, first, bit = self.code.unpacked(entry)
        sign = (2 * bit - 1).astype(np.float32)
        seen = [t.take(slot(h.take(order), at, salt, b)) for t, h, b in zip(self.tables, hashes, self.bits)]
        sure = np.abs(seen[FOUR])
        gate = first
        for least in SURE:
            gate += sure >= least
        odds, z = [], np.zeros(len(at), np.float32)
        for o, w in zip(seen, self.weights):
            o = o * sign
            z += o * w.take(gate)
            odds.append(o)
        return at, gate, odds, z

    def cost(self, raw: np.ndarray, offsets: np.ndarray, ends: np.ndarray | None = None, carry: Carry | None = None) -> np.ndarray:
        """Cost in nats of each piece. The first blocks of all pieces are coded together, then their second blocks...,
        longer pieces first. A piece with a carry is alone."""
        n = len(offsets) - 1
        symbols, starts = symbols_of(raw, offsets, np.ones(n, bool) if ends is None else ends)
        size = np.diff(starts)
        if not len(symbols):
            return np.zeros(n)
        rank = np.argsort(-size, kind="stable")
        size = size[rank]
        first = np.cumsum(size) - size
        place = np.arange(len(symbols)) - np.repeat(first, size)
        begin = carry.place if carry else 0
        past = int(block_of(np.array([begin]))[0])  # blocks of earlier pieces
        block = (block_of(place + begin) - past).astype(np.int16)
        turn = np.argsort(block, kind="stable")
        order = (np.repeat(starts[rank], size) + place)[turn]
        at, _, odds, z = self.bits_of(symbols, starts, order, carry)
        edges = block_edges(past, int(block[size[0] - 1]) + 1) - begin
        lengths = np.minimum(size[:, None], edges[1:]) - np.minimum(size[:, None], edges[:-1])  # of each piece in each block
        cuts = np.searchsorted(at, np.append(0, np.cumsum(lengths.T.reshape(-1)))).reshape(-1)
        more = np.zeros((len(odds), n), np.float32)
        if past and carry.more is not None:
            more[:] = carry.more
        goes_on = carry is not None and not ends[0]
        total = np.zeros(n)
        for k in range(lengths.shape[1]):
            here = int((lengths[:, k] > 0).sum())
            mark = cuts[k * n : k * n + here + 1]
            a, b = mark[0], mark[-1]
            own = z[a:b]
            if k or past:
                count = np.diff(mark)
                for o, m in zip(odds, more):
                    own += o[a:b] * np.repeat(m[:here], count)
            np.clip(own, -30, 30, out=own)
            e = np.exp(-own)  # the bit costs log(1 + e)
            e1 = e + np.float32(1)
            if goes_on or k + 1 < lengths.shape[1]:
                on = n if goes_on else int((lengths[:, k + 1] > 0).sum())  # the others are done
                c = mark[on] - a
                error = e[:c] / e1[:c]
                for o, m in zip(odds, more):
                    m[:on] += np.float32(STEP / SCALE**2) * np.add.reduceat(error * o[a : a + c], mark[:on] - a)
            total[:here] += np.add.reduceat(np.log(e1, out=e1), mark[:-1] - a)
        if goes_on:
            carry.more = more
        out = np.zeros(n)
        out[rank] = total
        return out

    def costs(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Cost in nats of each row, however long."""
        out = np.zeros(len(offsets) - 1)
        for rows, own, at, ends, carry in text_pieces(raw, offsets):
            np.add.at(out, rows, self.cost(own, at, ends, carry))
        return out


def curves(mixer: Mixer, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of the coding cost of some rows, by gate: slope, curvature and the number of bits, as one row of numbers each."""
    k = len(mixer.tables)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    out = np.zeros((GATES, k + len(pairs) + 1))
    for _, own, at, ends, carry in text_pieces(raw, offsets):
        symbols, starts = symbols_of(own, at, ends)
        _, gate, odds, z = mixer.bits_of(symbols, starts, np.arange(len(symbols)), carry)
        p = 1 / (1 + np.exp(np.clip(z, -30, 30)))  # of the wrong bit
        rows = [*(p * o for o in odds), *(p * (1 - p) * odds[i] * odds[j] for i, j in pairs), np.ones(len(p))]
        out += np.stack([np.bincount(gate, weights=r, minlength=GATES) for r in rows], 1)
    return out


def newton(weights: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """One step for the weights of every gate, held near where they are by a small ridge."""
    k = len(weights)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    out = weights.copy()
    for g in range(GATES):
        curve = np.eye(k) * (RIDGE * sums[g, -1] + 1)
        for (i, j), v in zip(pairs, sums[g, k:-1]):
            curve[i, j] += v
            curve[j, i] = curve[i, j]
        out[:, g] += np.clip(np.linalg.solve(curve, sums[g, :k]), -0.5 / SCALE, 0.5 / SCALE)
    return out


def learnt_weights(tuning: DataFrame, code: Code, tables: list[np.ndarray]) -> np.ndarray:
    """Starting weights that make the tuning texts cheap to code under tables that don't count them."""
    sent = tuning.sparkSession.sparkContext.broadcast((code, tables))
    weights = start_weights()
    for _ in range(ROUNDS):

        def run(batches: Iterator[pa.RecordBatch], now: np.ndarray = weights) -> Iterator[pa.RecordBatch]:
            mixer, total = Mixer(*sent.value, now), None
            for batch in batches:
                own = curves(mixer, *text_bytes(batch["text"]))
                total = own if total is None else total + own
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.reshape(-1))], ["at", "s"])

        sums = np.zeros(GATES * (2 * len(tables) + len(tables) * (len(tables) - 1) // 2 + 1))
        for at, s in tuning.select("text").mapInArrow(run, "at int, s double").groupBy("at").agg(F.sum("s")).collect():  # len(sums) rows
            sums[at] = s
        weights = newton(weights, sums.reshape(GATES, -1))
    return weights


def frequent(words: DataFrame, most: int) -> DataFrame:
    """Words with n above the least power of two that leaves ``most`` of them or fewer. (An ordered limit would bring
    that many rows of every partition together.)"""
    left, least = 0, 0
    for level, n in words.groupBy(F.floor(F.log2("n")).alias("level")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect():  # 64 rows at most
        left += n
        if left > most:
            least = 2 ** (level + 1)
            break
    return words.where(F.col("n") >= least)


def log10p(c: np.ndarray, n: int, v: int) -> np.ndarray:
    return np.log10((c + 0.1) / (n + 0.1 * (v + 1)))


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    docs = docs.select("doc_id", "text")
    train = docs.where(~held_out(F.col("doc_id")))
    counts = staged(first_pass(train))
    code, n_symbols = fitted_code(counts.where("triple IS NOT NULL").select("triple", "n"))
    words = counts.where("word IS NOT NULL").select("word", "n")
    size = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_all, v_all = size["n"] or 0, size["v"]
    ends = words.where(F.octet_length("word") == 0).agg(F.sum("n")).first()[0] or 0
    top = frequent(words, COMMON).collect()  # COMMON rows at most
    common = ([bytes(r["word"]) for r in top], np.array([r["n"] for r in top], np.int64))
    teaches = F.pmod(F.xxhash64("doc_id"), F.lit(TUNING)) == 0
    tuning = staged(train.where(teaches))
    alone, tables = context_tables(train.where(~teaches), tuning, code, table_bits(n_symbols))
    weights = learnt_weights(tuning, code, alone)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((*common, code, tables, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen_times, *model = sent.value
        mixer, worth = Mixer(*model), log10p(seen_times.astype(float), n_all, v_all)
        known = pa.array(known, pa.binary())
        end, end_known = float(log10p(np.float64(ends), n_all, v_all)), int(ends > 0)
        for batch in batches:
            cost = mixer.costs(*text_bytes(batch["text"]))
            n = batch.num_rows
            row, words = words_of(batch["text"])
            at = pc.index_in(words, value_set=known)
            common = at.is_valid().to_numpy(zero_copy_only=False)
            base = end + np.bincount(row[common], weights=worth[at.drop_null().to_numpy()], minlength=n)
            rare = np.bincount(row[~common], minlength=n)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(rare)), pa.int32()), words.filter(pa.array(~common)))
            total = np.bincount(row, minlength=n)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(total + 1), pa.array(total - rare + end_known), pa.array(base), lists, pa.array(-cost / np.log(10))], ["doc_id", "n_tokens", "n_known", "base", "rare", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    seen = docs.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, base double, rare array<binary>, score double")
    seen = staged(seen.withColumn("row", F.monotonically_increasing_id()))
    rare = seen.select("row", F.explode("rare").alias("word"))
    c = F.coalesce("n", F.lit(0))
    joined = rare.join(words, "word", "left").select(
        "row", F.log10((c + F.lit(0.1)) / F.lit(n_all + 0.1 * (v_all + 1))).alias("base"), (c > 0).cast("long").alias("known"),
    )
    added = joined.groupBy("row").agg(F.sum("base").alias("more"), F.sum("known").alias("hits"))
    return seen.join(added, "row", "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("hits", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))
