"""Toxicity and language-model scores: held-out quality, and plain versions of what is exact."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from gridmix.llm import mixing, toxicity
from gridmix.llm.common import text_bytes


def test_restores_written_over_words(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = toxicity.Restorer(toxicity.character_model(d))
    for token, word in (("1d10t", "idiot"), ("stuuuupid", "stupid"), ("m0ron", "moron"), ("l.o.s.e.r", "loser"), ("stupid$$$", "stupid"), ("tr@sh", "trash"), ("THE!!".lower(), "the")):
        assert word in r.words(token), (token, r.words(token))
    assert r.words("plain,") == ["plain"] and r.words("12345") == [] and r.words("---") == []


def test_spelled_words_are_joined(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    read = toxicity.Reader(toxicity.character_model(d), lambda f: f)
    assert {"idiot", "loser"} <= read("you i d i o t and l-o-s-e-r now")
    assert "moron" in read("what a m o r o n y")
    assert read(None) == read("") == set()


def test_spaced_words_are_segmented(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    read = toxicity.Reader(toxicity.character_model(d), lambda f: f)
    for text, words in (
        ("s t u p i d i d i o t", {"stupid", "idiot"}), ("(s t u p i d)", {"stupid"}), ("s  t  u  p  i  d", {"stupid"}),
        ("so 5 t u p 1 d", {"stupid"}), ("m*o*r*o*n", {"moron"}), ("iddiott", {"idiot"}),
    ):
        assert words <= read(text), (text, read(text))


def test_viterbi_is_the_best_of_all_paths(spark):
    import itertools

    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    r = toxicity.Restorer(toxicity.character_model(d))

    def score(puts, cost):
        a = b = 0
        for c in [*"".join(puts), " "]:
            z = toxicity.symbol(c) if c != " " else 0
            cost += r.log[a << 12 | b << 6 | z]
            a, b = b, z
        return cost

    for runs, spaced in (([("i", 1), ("1", 2), ("d", 3)], False), ([("$", 1), ("t", 1), ("0", 1), ("p", 2)], False), ([("m", 1), ("e", 1), ("1", 1), ("t", 1)], True), ([("5", 1), ("o", 1), ("a", 1)], True)):
        best = -math.inf
        for steps in itertools.product(*(r.steps(c, n) for c, n in runs)):
            for cuts in itertools.product((False, True), repeat=len(runs) - 1) if spaced else [(False,) * (len(runs) - 1)]:
                puts = [steps[0][0]] + [" " * cut + p for (p, _), cut in zip(steps[1:], cuts)]
                text = "".join(puts)
                if text.startswith(" ") or "  " in text:
                    continue
                best = max(best, score(puts, sum(c for _, c in steps) + toxicity.BREAK * sum(cuts)))
        assert math.isclose(r.best(runs, spaced)[0], best, rel_tol=1e-6), runs


def test_trigrams_do_not_depend_on_batches(spark, monkeypatch):
    texts = ["naïve café", None, "", "x", "東京 abc", "words of a text"] * 3
    want = Counter()
    for t in texts:
        s = [0, 0, *(toxicity.symbol(c) for c in t or ""), 0, 0]
        want.update(a << 12 | b << 6 | c for a, b, c in zip(s, s[1:], s[2:]))
    raw, off = text_bytes(pa.array(texts))
    for step in (1 << 20, 7):
        monkeypatch.setattr(toxicity, "STEP", step)
        s = toxicity.padded_symbols(raw, off).tolist()
        assert Counter(a << 12 | b << 6 | c for a, b, c in zip(s, s[1:], s[2:])) == want
        assert s[:2] == [0, 0] and len(s) == sum(len(t or "") for t in texts) + 2 * len(texts) + 2


def test_training_rows_are_bounded(spark):
    docs = spark.createDataFrame([(i % 40, f"text {i}") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    assert toxicity.training_rows(docs, labels, 10).count() <= 10 and toxicity.training_rows(docs, labels).count() <= 40


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = toxicity.toxicity(d, labels).collect()
    assert len(rows) == d.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    held = [(r["score"], r["predicted"], toxic[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in toxic]
    ones, zeros = [s for s, _, t in held if t], [s for s, _, t in held if not t]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])
    right = sum(p for _, p, t in held if t)
    assert auc > 0.85, auc
    assert right > 0.6 * len(ones) and sum(p for _, p, t in held if not t) <= 0.02 * len(zeros)


def test_toxicity_of_odd_rows(spark, docs, empty):
    labels = spark.createDataFrame([(6, 0, 1), (7, 1, None), (None, 1, 1), (8, 0, 0), (8, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.toxicity(empty, labels).count() == 0
    low = sum(r["score"] < 0.7 for r in got)
    kept = toxicity.clean(docs.withColumn("score", docs["doc_id"]), labels)
    assert kept.columns == [*docs.columns, "score"] and kept.count() == low


def plain_base(rows):
    split = lambda t: (t or "").encode().lower().split() + [None]
    train = Counter(x for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 10 for x in split(t))
    n, v = sum(train.values()), len(train)
    out = {}
    for d, t in rows:
        w = split(t)
        out[d] = (len(w), sum(train[x] > 0 for x in w), n, sum(math.log10((train[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
    return out


def test_base_scores(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(mixing, "COMMON", 5)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain_base(rows)
    got = mixing.scores(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            continue
        n, known, total, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total), r
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0
    assert mixing.scores(empty).count() == 0


def test_base_scores_of_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = plain_base([(r["doc_id"], r["text"]) for r in d.collect()])
    for r in mixing.scores(d).collect():
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[r["doc_id"]][:3] and math.isclose(r["base_score"], want[r["doc_id"]][3], rel_tol=1e-9)


TEXTS = ["abracadabra", "abra cad", "some words of a text, and again some words", "other words é 東京", "", "a text of words " * 90, "zzz", "b"]


def symbol_pairs(texts):
    out = np.zeros((257, 257), np.int64)
    for t in texts:
        own = [256, *t.encode(), 256]
        for a, b in zip(own, own[1:]):
            out[a, b] += 1
    return out


def frequent_states(texts, states):
    out = {t: np.zeros(257) for t in states}
    for text in texts:
        own = [256, 256, *text.encode(), 256]
        for b, a, s in zip(own, own[1:], own[2:]):
            if a * 257 + b in out:
                out[a * 257 + b][s] += 1
    return out


#: The starts of texts, and some pairs (the last symbol first).
STATES = [256 * 257 + 256, *(a * 257 + b for a, b in (b"ba", b"o ", b" s", b"xx"))]


def trained(texts, bits=(16, 18, 18), weights=None):
    frequent = frequent_states(texts, STATES)
    code = mixing.Code(symbol_pairs(texts), frequent)
    plain = PlainMixer(symbol_pairs(texts), bits, frequent)
    for t in texts:
        plain.count(t.encode())
    tables = []
    for b, seen in zip(bits, plain.seen):
        n = np.zeros((1 << b, 2), np.int64)
        for at, own in seen.items():
            n[at] = own
        tables.append(mixing.log_odds(n))
    weights = mixing.start_weights() if weights is None else weights
    plain.weights = weights
    return mixing.Mixer(code, tables, weights), plain


class PlainMixer:
    """The model text by text, symbol by symbol and bit by bit, in plain numbers. Only the shape of the code's trees is the module's."""

    M = (1 << 32) - 1

    def __init__(self, pairs, bits, frequent):
        prior = (pairs.sum(0) + 1) / (pairs.sum() + 257)
        known = [p for p in range(257) if pairs[p].any()]
        self.trees = {None: (0, mixing.code_paths(prior.tolist()))}
        self.trees |= {p: (k + 1, mixing.code_paths((pairs[p] + prior).tolist())) for k, p in enumerate(known)}
        self.trees |= {divmod(t, 257): (len(known) + k + 1, mixing.code_paths((own + prior).tolist())) for k, (t, own) in enumerate(frequent.items())}
        self.bits, self.seen = bits, [{} for _ in bits]

    def steps(self, text):
        """(depth, bit, slots) of every bit of a text, one list for each symbol."""
        symbols, m = [*text, 256], self.M
        for i, s in enumerate(symbols):
            b = [symbols[i - j] if i >= j else 256 for j in (1, 2, 3, 4)]
            two = (b[0] * 257 + b[1]) * 0x85EBCA6B & m
            four = (two ^ (b[2] * 257 + b[3]) * 0xC2B2AE35 & m) * 0x27D4EB2F & m
            j = i
            while j and symbols[j - 1] > 32:
                j -= 1
            word = sum((x + 1) * pow(0x01000193, d, 1 << 32) for d, x in enumerate(symbols[j:i])) + 0x165667B1
            hashes = [(h ^ h >> 13) * 0x2C1B3C6D & m for h in (two, four, word * 0x85EBCA77 & m)]
            tree, paths = self.trees.get((b[0], b[1])) or self.trees.get(b[0]) or self.trees[None]
            out = []
            for depth, (node, bit) in enumerate(paths[s]):
                salt = (tree * 257 + node + 1) * 0x9E3779B1 & m
                salt = (salt ^ salt >> 15) * 0x2C1B3C6D & m
                out.append((min(depth, 3), bit, [(h + salt & m) >> 32 - w for h, w in zip(hashes, self.bits)]))
            yield out

    def count(self, text):
        for own in self.steps(text):
            for _, bit, slots in own:
                for seen, at in zip(self.seen, slots):
                    seen.setdefault(at, [0, 0])[bit] += 1

    def odds(self, slots):
        return [max(-127, min(127, round(12 * math.log((n[1] + 0.35) / (n[0] + 0.35))))) for n in (seen.get(at, (0, 0)) for seen, at in zip(self.seen, slots))]

    def cost(self, text):
        total, more, slope = 0.0, [0.0] * 3, [0.0] * 3
        for i, own in enumerate(self.steps(text)):
            if i in (64, 128, 256, 512) or (i and i % 1024 == 0):
                more = [a + mixing.STEP / 144 * b for a, b in zip(more, slope)]
                slope = [0.0] * 3
            for depth, bit, slots in own:
                odds = self.odds(slots)
                gate = depth * 4 + sum(abs(odds[1]) >= x for x in (3, 20, 48))
                z = sum(o * (w[gate] + a) for o, w, a in zip(odds, self.weights, more)) * (2 * bit - 1)
                z = max(-30.0, min(30.0, z))
                total += math.log1p(math.exp(-z))
                wrong = (2 * bit - 1) / (1 + math.exp(z))
                slope = [a + wrong * o for a, o in zip(slope, odds)]
        return total


def test_mixer_is_the_plain_one():
    rng = np.random.default_rng(3)
    m, plain = trained(TEXTS[:6], weights=rng.uniform(0, 0.08, (3, mixing.GATES)))
    texts = [*TEXTS, "unseen Words, 123 " * 70, "x" * 3000, TEXTS[5] + TEXTS[2]]
    got = m.costs(*text_bytes(pa.array(texts)))
    assert np.allclose(got, [plain.cost(t.encode()) for t in texts], rtol=2e-4)


def test_model_is_a_distribution():
    """Over all first symbols and the end, probabilities add up to one."""
    _, plain = trained(TEXTS[:3])
    total = 0.0
    for b in range(257):
        first = next(plain.steps(bytes([b]) if b < 256 else b""))
        p = 1.0
        for depth, bit, slots in first:
            odds = plain.odds(slots)
            gate = depth * 4 + sum(abs(odds[1]) >= x for x in (3, 20, 48))
            p /= 1 + math.exp(-(2 * bit - 1) * sum(o * w[gate] for o, w in zip(odds, plain.weights)))
        total += p
    assert abs(total - 1) < 1e-9


def test_scores_do_not_depend_on_neighbours():
    m, _ = trained(TEXTS[:4])
    raw, off = text_bytes(pa.array(TEXTS))
    together = m.cost(raw, off)
    alone = [m.cost(*text_bytes(pa.array([t])))[0] for t in TEXTS]
    assert np.allclose(together, alone, rtol=1e-4)


def test_pieces_of_long_texts_do_not_show(monkeypatch):
    monkeypatch.setattr(mixing, "SLICE", 700)
    m, plain = trained(TEXTS[:6])
    texts = ["short", TEXTS[5] * 4, "", "x" * 5000, "a b " * 512, "one longer word " + "é" * 1100 + "\n more", "last " * 3000]
    raw, off = text_bytes(pa.array(texts))
    want, curves = m.costs(raw, off), mixing.curves(m, raw, off)
    assert np.allclose(want[:5], [plain.cost(t.encode()) for t in texts[:5]], rtol=2e-4)
    for piece in (1024, 2048, 3072):
        monkeypatch.setattr(mixing, "PIECE", piece)
        assert np.allclose(m.costs(raw, off), want, rtol=1e-6)
        assert np.allclose(mixing.curves(m, raw, off), curves, rtol=1e-6, atol=1e-6)


def test_codes_are_those_of_the_counts(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    triples = mixing.first_pass(rows).where("triple IS NOT NULL").select("triple", "n")
    code, n = mixing.fitted_code(triples, codes=7)
    counted = Counter(a * 257 + b for t in TEXTS for b, a in zip([256, 256, *t.encode()], [256, *t.encode()]))
    top = sorted(counted, key=lambda t: (-counted[t], t))[:7]
    want = mixing.Code(symbol_pairs(TEXTS), frequent_states(TEXTS, top))
    assert n == sum(len(t.encode()) + 1 for t in TEXTS)
    assert all((x == y).all() for x, y in ((code.row, want.row), (code.size, want.size), (code.packed, want.packed)))


def test_training_counts_do_not_depend_on_pieces(spark, monkeypatch):
    rows = spark.createDataFrame([(TEXTS[5] * 4,), ("x" * 5000 + " y",), ("short",), (None,)], "text string")
    code = mixing.Code(symbol_pairs(TEXTS))
    counted = []
    for piece in (1024, 1 << 18):
        monkeypatch.setattr(mixing, "PIECE", piece)
        pairs = {r["triple"]: r["n"] for r in mixing.first_pass(rows).where("triple IS NOT NULL").collect()}
        counted.append((pairs, mixing.context_tables(rows, rows.limit(0), code, (16, 18, 18))))
    assert counted[0][0] == counted[1][0]
    for one, other in zip(counted[0][1], counted[1][1]):
        assert all((x == y).all() and x.any() for x, y in zip(one, other))


def test_learnt_weights_are_better(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [t or "" for t, in d.select("text").limit(400).collect()]
    m, _ = trained(texts[:250:5])
    raw, off = text_bytes(pa.array(texts[250:]))
    weights = mixing.start_weights()
    for _ in range(mixing.ROUNDS):
        weights = mixing.newton(weights, mixing.curves(mixing.Mixer(m.code, m.tables, weights), raw, off))
    learnt = mixing.Mixer(m.code, m.tables, weights)
    assert learnt.costs(raw, off).sum() < m.costs(raw, off).sum()


def test_model_beats_words_on_held_out_rows(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = [r for r in mixing.scores(d).collect() if r["held_out"]]
    bits = -sum(r["score"] for r in held) / math.log10(2) / sum(len(t.encode()) for t, in d.where("crc32(cast(doc_id as string)) % 10 = 0").select("text").collect())
    assert bits < 2.9, bits


def test_refining_helps(monkeypatch):
    m, _ = trained(["quite other text with words", "the again and"])
    raw, off = text_bytes(pa.array(["the same words again and again " * 60]))
    refined = m.cost(raw, off)[0]
    monkeypatch.setattr(mixing, "STEP", 0.0)
    assert refined < m.cost(raw, off)[0]
