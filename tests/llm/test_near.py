"""Repeats, near-duplicates, decontamination, WARC: brute force on small inputs."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from gridmix.llm import decontam, repeats, simhash, warc
from tests.llm.conftest import SCHEMA, rows_of, words


def plain_repeats(texts, n=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + n] for r in raw for i in range(len(r) - n + 1))
    out = []
    for r in raw:
        cover = np.zeros(len(r) + 1, np.int32)
        for i in range(len(r) - n + 1):
            if seen[r[i : i + n]] > 1:
                cover[i] += 1
                cover[i + n] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, x in zip(r, gone) if not x)
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_texts():
    rng = random.Random(11)
    passage = words(rng, 90)
    base = [words(rng, 300, 5000) for _ in range(12)]
    texts = [None, "", "short"]
    texts += [f"{b} {passage} {words(rng, 40, 5000)}" for b in base]
    texts += [base[0], base[0], base[1][50:900], passage[:199], passage[:200], passage[7:] * 2, "a" * 900, "ab" * 300, "é" * 200 + passage[20:] + "ü" * 150]
    return texts


@pytest.mark.parametrize("most_classes", [repeats.MOST_CLASSES, 3, 1])
def test_repeats(spark, most_classes):
    texts = repeat_texts()
    df = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(4, "doc_id")
    rows = {r["doc_id"]: r for r in repeats.digests(repeats.repeats(df, most_classes)).collect()}
    for i, want in enumerate(plain_repeats(texts)):
        r = rows[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want, i


def test_repeats_of_odd_rows(docs, empty):
    assert repeats.digests(repeats.repeats(docs)).count() == docs.count()
    assert repeats.digests(repeats.repeats(empty)).count() == 0


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SLICE", 700)
    rng = random.Random(3)
    texts = [words(rng, 1500, 9000), words(rng, 100)]
    texts[0] += texts[0][300:1200]
    raw = texts[0].encode()
    at = {}
    for first, before, piece, off in repeats.row_pieces(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])):
        with np.errstate(over="ignore"):
            for row, anchor, kind, start, size in zip(*repeats.stretches(piece, off)):
                for s in range(start + before, start + before + size - 199):
                    assert s not in at  # every window is owned once
                    at[s] = anchor
    assert sorted(at) == list(range(len(raw) - 199))


def test_repeats_of_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in d.collect()]
    want = dict(zip((i for i, _ in rows), plain_repeats([t for _, t in rows])))
    for r in repeats.digests(repeats.repeats(d)).collect():
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]]


def test_bytes_decide_not_hashes(spark):
    """Two places of a class whose bytes differ, as under equal hashes: only what they share may go."""
    rng = random.Random(12)
    one, other = bytearray(rng.randbytes(500)), None
    other = bytes(one[:230]) + b"\x00" + bytes(one[231:400])
    texts = [(7, 1, 2, 0, None, bytes(one)), (7, 1, 2, 1, None, other), (8, 3, 4, 0, None, rng.randbytes(300)), (8, 3, 4, 1, None, rng.randbytes(300))]
    df = spark.createDataFrame(texts, "key long, anchor long, class long, copy int, members binary, bytes binary")
    assert sorted(tuple(r) for r in repeats.indexed(df, 2).collect()) == [(1, 2, 0, 230)]


def test_windows_around_a_gram_are_dealt_out_once():
    rng = random.Random(13)
    for _ in range(300):
        size, gram = rng.randrange(200, 321), rng.choice([80, 140, 170, 185, 193, 197, 199])
        text = bytes(rng.randrange(256) for _ in range(size))
        place = rng.randrange(size - gram + 1)
        starts = [s for s in range(size - 199) if s <= place and s + 200 >= place + gram]
        if starts != list(range(size - 199)):
            continue  # every window of a stretch holds its gram
        dealt = []
        for longer, at, a, b in repeats.halves(text, place, gram):
            assert text[a + at : a + at + len(longer) - 1] == longer[1:]
            own = range(a, b - 199)
            assert all(s <= a + at and s + 200 >= a + at + len(longer) - 1 for s in own)
            dealt += own
        assert sorted(dealt) == starts


def test_run_length_index():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 60))) for _ in range(20)]
    index = repeats.RunLengthIndex(texts)
    assert index.lengths.sum() == sum(len(t) + 1 for t in texts)
    ms = index.matching_statistics()
    for i, t in enumerate(texts):
        for k in range(len(t)):
            best = max(next((n for n in itertools.count() if k + n >= len(t) or m + n >= len(u) or t[k + n] != u[m + n]), 0) for j, u in enumerate(texts) for m in range(len(u)) if (j, m) != (i, k))
            assert ms[index.starts[i] + k] == best


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 3:
            root[find(a)] = find(b)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)].append(doc_id)
    return [(d, f"{fps[i]:016x}", min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)]


def near_rows():
    rng = random.Random(8)
    rows, n = [], 0
    for _ in range(12):
        base = words(rng, 400, 3000).split()
        for _ in range(8):
            own = list(base)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(99)}"
            rows.append((n, " ".join(own)))
            n += 1
    rows += [(n + i, words(rng, 50, 3000)) for i in range(60)]
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "Two words"), (904, "two WORDS"), (905, "x"), (None, "no id"), (3, rows[3][1])]


@pytest.mark.parametrize("hot", [simhash.HOT, 2])
def test_simhash(spark, hot, monkeypatch):
    if hot == 2:
        monkeypatch.setattr(simhash, "FREE", 30)
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(str, (tuple(r) for r in simhash.near_duplicates(df, hot).collect())))
    assert got == sorted(map(str, plain_components(rows)))


def test_simhash_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = sorted(map(str, (tuple(r) for r in simhash.near_duplicates(d).collect())))
    assert got == sorted(map(str, plain_components([tuple(r) for r in d.collect()])))


def test_keep_one(spark, empty, docs):
    rows = [r for r in near_rows() if r[0] is not None]
    df = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, own string")
    want = sorted({c for _, _, c in plain_components(rows)})
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == want
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
    assert simhash.near_duplicates(docs).count() == docs.count()


def test_plan_covers_every_difference():
    rng = np.random.default_rng(4)
    fps = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    x = np.unpackbits(fps.view(np.uint8), bitorder="little").reshape(-1, 64).astype(float)
    parts = simhash.plan(fps, len(fps), x.T @ x)
    bits = [b for own, _ in parts for b in own]
    assert len(bits) == len(set(bits)) and sum(t + 1 for _, t in parts) == 4


def test_large_groups_are_searched_not_paired():
    rng = np.random.default_rng(6)
    centre = rng.integers(0, 2**63, 30, dtype=np.uint64)
    fp = np.unique(np.array([centre[i % 30] ^ (np.uint64(1) << np.uint64(i // 30 % 64)) for i in range(1900)], np.uint64))
    a, b = simhash.links(np.zeros(len(fp), np.int64), fp)
    assert len(a) < len(fp)
    root = dict(zip(a.tolist(), b.tolist()))
    for x, y in itertools.combinations(fp.tolist(), 2):
        if (x ^ y).bit_count() <= 3:
            assert root.get(x, x) == root.get(y, y)


def plain_contained(docs, items):
    def grams(t):
        w = (t or "").encode().lower().split()
        return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    out = set()
    for (d, t), (i, u) in itertools.product(docs, items):
        q = grams(u)
        n = len(q & grams(t))
        if q and n * 5 >= len(q) * 4:
            out.add((d, i, len(q), n))
    return out


@pytest.mark.parametrize("block", [decontam.BLOCK_BYTES, 600])
def test_decontamination(spark, empty, block):
    rng = random.Random(21)
    items = [(i, words(rng, n, 3000)) for i, n in enumerate((3, 5, 9, 12, 20, 33, 60, 100))] + [(50, None), (51, ""), (52, "one two")]
    texts = []
    for _, t in items:
        w = (t or "").split()
        for cut in (0, 0.1, 0.19, 0.3, 0.5):
            own = w[int(len(w) * cut) :]
            texts.append(f"{words(rng, 200, 3000)} {' '.join(own).upper()} {words(rng, 100, 3000)}")
    texts += [None, "", "one TWO", items[5][1], items[7][1]]
    rows = rows_of(texts)
    df, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items + [items[4]], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"]) for r in decontam.contaminated(df, bench, block).collect()}
    want = plain_contained([(r[0], r[1]) for r in rows], items)
    assert got == want and len(want) > 20
    clean = decontam.clean(df, bench, block)
    assert clean.columns == df.columns
    assert {r["doc_id"] for r in clean.collect()} == {r[0] for r in rows} - {d for d, *_ in want}
    none = bench.where("item_id < 0")
    assert decontam.contaminated(empty, bench).count() == 0 and decontam.contaminated(df, none).count() == 0


def test_warc(spark):
    big = "<p>" + "é" * 600
    pages = [(1, "u1", big), (5, "u5", big), (3, None, big), (2, "u2", "small"), (4, "u4", "small"), (6, "u6", None), (7, "u7", ""), (8, "a\nb: c", big + "x\r\n\r\nWARC/1.1\r\n"), (5, "again", big)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    folder = warc.shared_dir(spark)
    index = warc.write_archives(warc.with_roles(df), folder)
    rows = sorted(warc.read_records(index, folder).collect(), key=lambda r: (r["page_id"], str(r)))
    assert len(rows) == len(pages)
    texts = {p: (h or "").encode() for p, _, h in pages}
    for r in rows:
        raw = texts[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), hashlib.sha1(raw).hexdigest())
        same = r["page_id"] in (1, 3)
        assert (r["record_type"], r["refers_to"]) == (("revisit", 5) if same else ("response", None))
    one = warc.read_records(index.where("page_id = 8"), folder).collect()
    assert len(one) == 1 and one[0]["payload_bytes"] == len(texts[8])
    assert warc.read_records(warc.write_archives(warc.with_roles(df.limit(0)), folder), folder).count() == 0


def plain_records(raw):
    """Records of an uncompressed archive by a parser of its own: (fields in lower case, block)."""
    at = 0
    while at < len(raw):
        line, fields = b"", {}
        end = raw.index(b"\r\n", at)
        assert raw[at:end] == b"WARC/1.1"
        at = end + 2
        while (end := raw.index(b"\r\n", at)) != at:
            line = raw[at:end]
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode()] = value.strip().decode()
            at = end + 2
        size = int(fields["content-length"])
        yield fields, raw[at + 2 : at + 2 + size]
        at += 2 + size
        assert raw[at : at + 4] == b"\r\n\r\n"
        at += 4


def test_archives_are_standard(spark):
    import glob
    import gzip
    import zlib

    big = "<p>" + "é" * 600
    pages = [("a\nb", "http://x/1", big), ("", "http://x/2\r\nEvil: 1", big), (None, None, "x\r\n\r\ny"), ("z\u2028", "http://é/", big), ("q", "u", None)]
    df = spark.createDataFrame(pages, "page_id string, url string, html string").repartition(2)
    folder = warc.shared_dir(spark)
    index = warc.write_archives(warc.with_roles(df), folder)
    records = {}
    for name in glob.glob(folder.removeprefix("file://") + "/*.warc.gz"):
        with gzip.open(name) as f:
            for fields, block in plain_records(f.read()):
                records[fields["warc-record-id"]] = (fields, block)
        with open(name, "rb") as f:
            raw = f.read()
        for r in index.where(index.file == name.rsplit("/", 1)[1]).collect():  # each index row is one whole gzip member
            member = zlib.decompressobj(31)
            assert len(list(plain_records(member.decompress(raw[r["offset"] : r["offset"] + r["length"]])))) == 1 and member.eof
    assert len(records) == len(pages)
    for fields, block in records.values():
        head, _, payload = block.partition(b"\r\n\r\n")
        assert fields["content-type"].startswith("application/http") and head.startswith(b"HTTP/1.1 200")
        if fields["warc-type"] == "revisit":
            to, body = records[fields["warc-refers-to"]]
            assert to["warc-target-uri"] == fields["warc-refers-to-target-uri"] and to["warc-date"] == fields["warc-refers-to-date"]
            assert to["warc-payload-digest"] == fields["warc-payload-digest"] and to["warc-type"] == "response" and payload == b""
        else:
            assert fields["warc-payload-digest"] == "sha1:" + hashlib.sha1(payload).hexdigest()
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.read_records(index, folder).collect()}
    assert got == {"a\nb": ("revisit", "z\u2028"), "": ("revisit", "z\u2028"), None: ("response", None), "z\u2028": ("response", None), "q": ("response", None)}


def test_reading_is_dealt_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "TASK", 1000)
    folder = warc.shared_dir(spark)
    index = warc.write_archives(warc.with_roles(spark.range(300).selectExpr("id AS page_id", "'u' AS url", "sha2(CAST(id AS string), 512) AS html")), folder)
    found = warc.read_records(index, folder)
    assert found.rdd.getNumPartitions() > 20 and found.count() == 300


def test_ranges_are_coalesced():
    rows = [(0, 10), (10, 10), (25, 5), (1000, 10), (1005, 50)]
    assert list(warc.ranges(rows, gap=5, most=10_000)) == [(0, 3, 0, 30), (3, 5, 1000, 55)]
    assert list(warc.ranges(rows[:2], gap=5, most=12)) == [(0, 1, 0, 10), (1, 2, 10, 10)]
