"""Conforming, clock changes, upsert, quality checks, windows, incremental loads."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix.functions import instants, text
from gridmix.operators import quality, upsert, windows
from gridmix.operators.conform import conform
from gridmix.sources import payloads, tables
from gridmix.sources.seeds import SCHEMAS, read_seed, seed
from gridmix.specs import NATIONAL_TR, REGIONAL_CONS_DEF, SPECS, TEMPO, CONSTRAINTS, DATASETS, PART, Dataset, by_month, layer_path
from gridmix.streaming.incremental import load_landed

UTC = dt.timezone.utc
NOW = dt.datetime(2026, 7, 1, 3, tzinfo=UTC)
SMALL = Dataset("Small set", ("date_heure", "code"), ("label",), ("a", "b"), "date_heure", by_month("date_heure"))


def test_specs():
    assert SMALL.table == "small_set" and SMALL.time == "date_heure" and SMALL.series == ["code"]
    assert len(SPECS) == 7 and not SMALL.stored["code"].nullable and SMALL.stored["a"].dataType == T.DoubleType()
    for key, texts, time in (((), (), None), (("a",), (), "t"), (("a",), ("a",), None)):
        with pytest.raises(ValueError):
            Dataset("x", key, texts, (), time)
    with pytest.raises(ValueError):
        layer_path("/x", "copper", "t")


def resolved(spark, texts, series=None):
    rows = [(i, t, (series or ["a"] * len(texts))[i]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "_seq long, t string, code string")
    out = instants.resolve_instants(df, "t", ["code"]).orderBy("_seq").select(F.col("t").cast("timestamp_ntz").alias("t"), "_gap").collect()
    return [(r.t, r._gap) for r in out]


def test_texts_to_instants(spark):
    got = resolved(spark, ["2026-07-01T12:00:00+02:00", "2026-07-01T10:00Z", "2026-07-01 12:00", "2026-03-29T02:30:00", "2026-03-29T03:00:00", None, "junk"])
    ten = dt.datetime(2026, 7, 1, 10)
    assert [t for t, _ in got[:3]] == [ten] * 3 and got[3][1] and got[4] == (dt.datetime(2026, 3, 29, 1), False)
    assert got[5][0] is None and got[6][0] is None


def test_repeated_hour(spark):
    base = dt.datetime(2026, 10, 25)
    assert [t for t, _ in resolved(spark, ["2026-10-25T02:00", "2026-10-25T02:00"])] == [base, base + dt.timedelta(hours=1)]
    assert resolved(spark, ["2026-10-25T02:30"])[0][0] == base + dt.timedelta(minutes=30)
    two = resolved(spark, ["2026-10-25T02:00"] * 4, ["a", "b", "a", "b"])
    assert [t.hour for t, _ in two] == [0, 0, 1, 1]


def sequential(texts):
    """One series in arrival order, as a loop."""
    from zoneinfo import ZoneInfo

    paris, last, out = ZoneInfo("Europe/Paris"), None, []
    for t in texts:
        local = dt.datetime.fromisoformat(t)
        a, b = (local.replace(tzinfo=paris, fold=f).astimezone(UTC).replace(tzinfo=None) for f in (0, 1))
        last = b if a != b and last is not None and last >= a else a
        out.append(last)
    return out


def test_repeated_hour_against_a_loop(spark):
    rng = random.Random(4)
    series, texts, want = [], [], []
    for k in range(60):
        instant, own = dt.datetime(2026, 10, 24, 22) + dt.timedelta(minutes=15 * rng.randrange(8)), []
        for _ in range(rng.randrange(2, 30)):
            own.append((instant.replace(tzinfo=UTC).astimezone(__import__("zoneinfo").ZoneInfo("Europe/Paris"))).strftime("%Y-%m-%dT%H:%M"))
            instant += dt.timedelta(minutes=15 * rng.randrange(1, 4))
        texts += own
        series += [f"s{k}"] * len(own)
        want += sequential(own)
    assert [t for t, _ in resolved(spark, texts, series)] == want


def test_conform(spark):
    rows = [("2026-07-01T00:00Z", " x ", "", "1.5", "true", 0), ("2026-07-01T00:15Z", "x", "l", " ", "1e3", 1), ("2026-07-01T00:30Z", "  ", "l", "1", "1", 2), (None, "x", "l", "1", "1", 3), ("2026-03-29T02:30", "x", "l", "1_000", "1d", 4)]
    raw = spark.createDataFrame(rows, "date_heure string, code string, label string, a string, unknown string, _seq long")
    c = conform(raw, SMALL, NOW)
    got = c.rows.orderBy("_seq").collect()
    assert c.missing == ["b"] and [(r.code, r.label, r.a, r.b) for r in got] == [("x", None, 1.5, None), ("x", "l", None, None)]
    assert c.rows.drop("_seq").columns == SMALL.stored.fieldNames()
    assert (c.without_key.count(), c.in_gap.count()) == (2, 1)
    with pytest.raises(ValueError):
        conform(raw, SMALL, dt.datetime(2026, 1, 1))
    with pytest.raises(Exception, match="does not exist"):
        conform(raw, SMALL, NOW, strict=True).rows.collect()
    flags = spark.createDataFrame([(True,)], "a boolean").select(text.to_measure(F.col("a"), True)).first()[0]
    assert flags is None
    values = ["1", "+1.5", ".5", "1e-3", "1d", "1_000", "abc", " ", None, "inf"]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "a string").select(text.to_measure(F.col("a"))).collect()]
    assert got == [1.0, 1.5, 0.5, 0.001, None, None, None, None, None, float("inf")]


def batch(spark, rows):
    """(minute, a, b, hour of ingestion)"""
    return spark.createDataFrame([(dt.datetime(2026, 7, 1, 0, m, tzinfo=UTC), "x", None, a, b, NOW + dt.timedelta(hours=h), "small", i) for i, (m, a, b, h) in enumerate(rows)], T.StructType([*SMALL.stored.fields]).add("_seq", "long"))


def test_upsert(spark, tmp_path):
    base = f"file://{tmp_path}"
    load = lambda rows: upsert.upsert(spark, base, SMALL, batch(spark, rows))
    content = lambda: sorted((r.date_heure.minute, r.a) for r in tables.bronze(spark, base, SMALL).select(F.col("date_heure").cast("timestamp_ntz").alias("date_heure"), "a").collect())
    assert tables.bronze(spark, base, SMALL).count() == 0
    r = load([(0, 1.0, 1.0, 0), (15, 2.0, None, 0)])
    assert (r.rows_inserted, r.rows_updated, r.rows_deduplicated) == (2, 0, 0)
    r = load([(0, 1.0, 1.0, 0), (15, 2.0, None, 0)])
    assert (r.rows_inserted, r.rows_updated) == (0, 2) and content() == [(0, 1.0), (15, 2.0)]  # a replay
    r = load([(15, 3.0, None, 0), (15, 4.0, 1.0, 0), (30, 5.0, None, 2), (30, 6.0, 6.0, 1)])
    assert (r.rows_in_batch, r.rows_merged, r.rows_inserted, r.rows_updated, r.rows_deduplicated) == (4, 2, 1, 1, 2)
    assert content() == [(0, 1.0), (15, 4.0), (30, 5.0)]  # the fullest, the newest
    assert load([(0, 9.0, None, -5)]).rows_updated == 1 and content()[0] == (0, 9.0)  # the batch loaded last wins
    assert load([]).rows_merged == 0 and len(content()) == 3


def test_ingest_and_stream(spark, tmp_path):
    base = f"file://{tmp_path}"
    raw = spark.createDataFrame([("2026-06-30T22:00Z", "France", "Données temps réel", "45000", 0), ("2026-06-30T22:15Z", "France", "Données temps réel", "", 1)], "date_heure string, perimetre string, nature string, consommation string, _seq long")
    for _ in range(2):
        got = upsert.ingest(spark, base, NATIONAL_TR, raw, NOW, "manual run/1")
    assert (got["rows"], got["rows_updated"], got["dataset_id"]) == (2, 2, "national_tr")
    assert tables.bronze(spark, base, NATIONAL_TR).count() == 2
    folder, at = f"{base}/streamed", f"{base}/checkpoint"
    for rows in ([(0, 1.0, None, 0), (15, 2.0, None, 0)], [(15, 3.0, None, 1)]):
        batch(spark, rows).drop("_seq").write.mode("append").parquet(folder)
        load_landed(spark, base, SMALL, folder, at).awaitTermination()
    assert sorted(r.a for r in tables.bronze(spark, base, SMALL).collect()) == [1.0, 3.0]
    with pytest.raises(tables.MissingTable):
        tables.gold(spark, base, "nothing")
    tables.write_full(raw, base, "gold", "t")
    assert tables.gold(spark, base, "t").count() == 2


def test_upsert_reads_only_the_folders_of_the_batch(spark, tmp_path):
    base = f"file://{tmp_path}"
    day = lambda month: dt.datetime(2026, month, 5, tzinfo=UTC)
    rows = lambda pairs: spark.createDataFrame([(day(m), "x", None, a, None, NOW, "small") for m, a in pairs], SMALL.stored)
    upsert.upsert(spark, base, SMALL, rows([(5, 1.0), (6, 2.0), (7, 3.0)]))
    plan = tables.parted(spark, base, SMALL).where(F.col(PART).isin("2026-06"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in plan.replace("PartitionFilters: [_part", "PartitionFilters: [isnotnull(_part"), plan
    assert "_part" in plan.split("PartitionFilters: [")[1].split("]")[0]
    path = tmp_path / "bronze" / "small_set"
    before = {f: f.stat().st_mtime_ns for f in path.glob("_part=*/*.parquet")}
    r = upsert.upsert(spark, base, SMALL, rows([(6, 9.0), (8, 4.0)]))
    assert (r.rows_inserted, r.rows_updated) == (1, 1)
    after = {f: f.stat().st_mtime_ns for f in path.glob("_part=*/*.parquet")}
    same = {f for f in before if after.get(f) == before[f]}
    assert {f.parent.name for f in same} == {"_part=2026-05", "_part=2026-07"}
    assert sorted(r.a for r in tables.bronze(spark, base, SMALL).collect()) == [1.0, 3.0, 4.0, 9.0]


def test_folders_are_dealt_by_size(spark, tmp_path):
    """A large folder is written by several tasks, small ones by one each: files follow the rows of their own folder."""
    base = f"file://{tmp_path}"
    own = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    at = lambda month, i: dt.datetime(2026, month, 5, i // 3600 % 24, i // 60 % 60, i % 60, tzinfo=UTC)
    rows = [(at(7, i), f"code {i * 7919 % 10007}", f"label {i * i % 9973}", float(i), None, NOW, "small") for i in range(9000)]
    rows += [(at(m, 0), "x", None, 1.0, None, NOW, "small") for m in (1, 2, 3, 4, 5)]
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        upsert.upsert(spark, base, SMALL, spark.createDataFrame(rows, SMALL.stored).repartition(4))
    finally:
        for k in own:
            spark.conf.unset(k)
    folder = tmp_path / "bronze" / "small_set"
    files = {f.name: len(list(f.glob("*.parquet"))) for f in folder.glob("_part=*")}
    assert files.pop("_part=2026-07") > 2 and set(files.values()) == {1} and tables.bronze(spark, base, SMALL).count() == 9005
    assert quality.unsorted_files(tables.parted(spark, base, SMALL), list(SMALL.key)).count() == 0


def test_one_scan_of_the_touched_folders(spark, tmp_path):
    base = f"file://{tmp_path}"
    upsert.upsert(spark, base, SMALL, batch(spark, [(0, 1.0, None, 0), (15, 2.0, None, 0)]))
    plan = upsert.one_merge(tables.parted(spark, base, SMALL).where(F.col(PART).isin("2026-07")), batch(spark, [(15, 3.0, None, 0)]).drop("_seq"), SMALL, Observation())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") == 1 and "PartitionFilters: [" in text and text.count("FullOuter") >= 1


def test_unchanged_folders_are_left_alone(spark, tmp_path):
    """24 months are read again, one of them revised: only that one is written."""
    base = f"file://{tmp_path}"
    at = lambda k: dt.datetime(2024 + k // 12, k % 12 + 1, 5, tzinfo=UTC)
    rows = lambda value, later=0: spark.createDataFrame([(at(k), c, None, value(k), None, NOW + dt.timedelta(days=later), "small") for k in range(24) for c in "xy"], SMALL.stored)
    upsert.upsert(spark, base, SMALL, rows(float))
    path = tmp_path / "bronze" / "small_set"
    times = lambda: {f.parent.name: f.stat().st_mtime_ns for f in path.glob("_part=*/*.parquet")}
    before = times()
    r = upsert.upsert(spark, base, SMALL, rows(lambda k: -1.0 if k == 17 else float(k), 30), skip_unchanged=True)
    assert r.touched == ("2025-06",) and len(r.unchanged) == 23 and (r.rows_in_batch, r.rows_merged, r.rows_updated, r.rows_inserted) == (48, 48, 48, 0)
    assert {p for p, t in times().items() if before[p] != t} == {"_part=2025-06"}
    got = tables.bronze(spark, base, SMALL)
    assert got.where("a = -1").count() == 2 and got.count() == 48 and got.where("ingested_at_utc > '2026-07-15'").count() == 2
    r = upsert.upsert(spark, base, SMALL, rows(float).limit(3), skip_unchanged=True)  # parts of folders are merged as ever
    assert (r.rows_merged, r.rows_inserted) == (3, 0) and tables.bronze(spark, base, SMALL).count() == 48


def test_ingest_counts_what_it_leaves_out(spark, tmp_path):
    base = f"file://{tmp_path}"
    rows = [("2026-07-01T00:00Z", "x", "1.5", 0), ("2026-07-01T00:15Z", "x", "n/a", 1), ("2026-07-01T00:30Z", " ", "1", 2), (None, "x", "1", 3), ("2026-03-29T02:30", "x", "?", 4), ("2026-07-02T00:00Z", "x", " ", 5)]
    raw = spark.createDataFrame(rows, "date_heure string, code string, a string, _seq long")
    got = upsert.ingest(spark, base, SMALL, raw, NOW, "one")
    assert (got["records"], got["rows"], got["without_key"], got["in_gap"], got["unreadable"], got["missing"], got["touched"]) == (6, 3, 2, 1, {"a": 2}, ["label", "b"], ("2026-07",))
    w = instants.TimeWindow(dt.datetime(2026, 7, 1, tzinfo=UTC), dt.datetime(2026, 7, 2, tzinfo=UTC))
    assert upsert.ingest(spark, base, SMALL, raw, NOW, "two", w)["rows"] == 2
    nothing = upsert.ingest(spark, base, SMALL, raw.limit(0), NOW, "none")
    assert (nothing["records"], nothing["rows"], nothing["touched"]) == (0, 0, ())
    with pytest.raises(ValueError, match="no instants"):
        upsert.ingest(spark, base, CONSTRAINTS, spark.createDataFrame([("x",)], "region string"), NOW, "w", w)
    assert not (tmp_path / "landing" / CONSTRAINTS.table).exists()


def test_stream_keeps_the_last_to_arrive(spark, tmp_path):
    base = f"file://{tmp_path}"
    seen = []
    batch(spark, [(0, float(i), None, 0) for i in range(40)]).repartition(4).write.parquet(f"{base}/streamed")
    load_landed(spark, base, SMALL, f"{base}/streamed", f"{base}/checkpoint", seen.append).awaitTermination()
    assert [r.a for r in tables.bronze(spark, base, SMALL).collect()] == [39.0]
    assert [(r.rows_in_batch, r.touched) for r in seen] == [(40, ("2026-07",))]


def test_landing_tables_and_windows(spark, tmp_path):
    base = f"file://{tmp_path}"
    landed = upsert.land(batch(spark, []), f"{base}/landing", "run 1", NOW.date())
    assert spark.read.parquet(landed).count() == 0 and list((tmp_path / "landing").glob("*/*/*.parquet"))  # an empty batch is landed
    assert tables.ensure_tables(spark, base) == [d.table for d in DATASETS] and tables.ensure_tables(spark, base) == []
    assert tables.bronze(spark, base, TEMPO).count() == 0
    w = instants.TimeWindow.last_hours(3, NOW)
    with pytest.raises(ValueError):
        tables.bronze(spark, base, CONSTRAINTS, w)
    upsert.upsert(spark, base, SMALL, batch(spark, [(0, 1.0, None, 0)]))
    assert tables.bronze(spark, base, SMALL, w).count() == 1


def test_geocoder_errors(spark):
    feature = '{"features":[{"geometry":{"coordinates":[1.0,2.0]},"properties":%s}]}'
    rows = [
        (1, '{"features":[]}'), (2, feature % '{"score":0.9,"type":"street","context":"69, Rhône, Auvergne-Rhône-Alpes"}'), (3, feature % '{"citycode":"69123","context":"Rhône","score":0.4,"type":"street"}'),
        (4, feature % '{"citycode":"97411","context":"974, La Réunion"}'), (5, feature % '{"citycode":"69123","score":0.39,"type":"housenumber","context":"69, Rhône, Auvergne-Rhône-Alpes"}'), (6, "no json"),
    ]
    got = {r.id: r for r in payloads.geocoded(spark.createDataFrame(rows, "id long, value string"), seed(spark, "dim_region")).collect()}
    assert [got[i].erreur for i in range(1, 7)] == ["introuvable", "sans_commune", "contexte", None, None, "introuvable"]
    assert (got[4].score, got[4].score_faible, got[4].precision_grossiere, got[4].code_departement, got[4].code_insee_region) == (0.0, True, True, "974", "04")
    assert (got[5].score_faible, got[5].precision_grossiere, got[5].code_departement) == (True, False, "69") and got[3].score_faible is False


def test_windows_of_time():
    now = dt.datetime(2026, 10, 8, 12, tzinfo=UTC)
    assert instants.TimeWindow.last_hours(3, now).start == now - dt.timedelta(hours=3)
    assert instants.TimeWindow.last_months(24, now).start == dt.datetime(2024, 9, 30, 22, tzinfo=UTC)
    for a, b in ((now, now), (now.replace(tzinfo=None), now)):
        with pytest.raises(ValueError):
            instants.TimeWindow(a, b)
    r = instants.DayRange.month(2026, 12, day_before=True)
    assert (r.start, r.end) == (dt.date(2026, 11, 30), dt.date(2027, 1, 1))
    assert [(c.end - c.start).days for c in instants.DayRange(dt.date(2020, 1, 1), dt.date(2022, 1, 1)).chunks()] == [366, 365]
    assert r.until_tomorrow(dt.date(2026, 12, 1)).end == dt.date(2026, 12, 3)
    assert text.safe_run_id("manual__2026-07-01T00:00+00:00") == "manual__2026-07-01T00-00-00-00" and text.safe_run_id("///") == "run"


def test_sources(spark, tmp_path):
    (tmp_path / "e.csv").write_bytes("﻿date_heure;code;a\n2026-07-01T00:00Z;01;\n2026-07-01T00:15Z;02;5\n".encode())
    rows = payloads.read_delimited(spark, str(tmp_path / "e.csv"))
    assert rows.columns == ["date_heure", "code", "a", "_seq"] and [(r.code, r.a) for r in rows.collect()] == [("01", None), ("02", "5")]
    pages = spark.createDataFrame([(1, '{"results":[{"date_heure":"c"}]}'), (0, '{"total_count":3,"results":[{"date_heure":"a","couleur":"RED"},{"date_heure":"b","x":1}]}')], "page long, value string")
    assert [tuple(r) for r in payloads.records_of_pages(pages, TEMPO).orderBy("_seq").select("date_heure", "couleur").collect()] == [("a", "RED"), ("b", None), ("c", None)]
    calendar = spark.createDataFrame([('{"tempo_like_calendars":{"values":[{"start_date":"2026-07-02","value":"NOT"},{"start_date":"2026-07-01","value":"BLUE"}]}}',)], "value string")
    assert [tuple(r) for r in payloads.calendar_days(calendar).collect()] == [("2026-07-01", "BLUE")]
    for name in SCHEMAS:
        df = seed(spark, name)
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"file://{tmp_path}/{name}")
        assert read_seed(spark, f"file://{tmp_path}/{name}", name).count() == df.count()
    assert (seed(spark, "dim_departement").count(), seed(spark, "dim_region").count(), seed(spark, "tarifs_tempo").count()) == (101, 18, 12)


def test_greedy_windows_against_a_loop(spark):
    rng = random.Random(9)
    rows = [(k % 3, i, dt.datetime(2026, 1, 1) + dt.timedelta(hours=i), float(rng.randrange(20))) for k in range(3) for i in rng.sample(range(200), 80)]
    df = spark.createDataFrame(rows, "g long, i long, at timestamp_ntz, price double")
    got = windows.disjoint_best(df, "g", [F.col("price"), F.col("at")], 5, F.col("at"), F.make_dt_interval(hours=F.lit(3)), ["i"]).collect()
    for g in range(3):
        kept = []
        for _, i in sorted((r[3], r[1]) for r in rows if r[0] == g):
            if len(kept) < 5 and all(abs(i - j) >= 3 for j in kept):
                kept.append(i)
        assert [r.i for r in sorted(got, key=lambda r: r.rang) if r.g == g] == kept
    with pytest.raises(ValueError):
        windows.sliding_windows(df, 0)


def test_quality(spark):
    df = spark.createDataFrame([(1, None, 5.0, "ab"), (1, None, -1.0, "abc"), (2, "x", None, None)], "k long, s string, v double, c string")
    assert [tuple(r) for r in quality.not_unique(df, ["k", "s"]).collect()] == [(1, None, 2)]
    got = {r.check: (r.violations, r.verdict) for r in quality.summary(df, [quality.Check("null", quality.is_null("s"), "warn"), quality.Check("range", quality.out_of_range("v", 0)), quality.Check("values", quality.not_accepted("s", ["x"])), quality.Check("length", quality.wrong_length("c", 2))]).collect()}
    assert got == {"null": (2, "warn"), "range": (1, "error"), "values": (0, "pass"), "length": (1, "error")}
    parent = spark.createDataFrame([("y",)], "id string")
    assert quality.orphans(df, "s", parent, "id").count() == 1
    t = lambda h, m=0, d=1: dt.datetime(2026, 7, d, h, m)
    series = spark.createDataFrame([(t(0), 30), (t(0, 30), 45), (t(1), 30), (t(23, 30), 60), (t(0, 15, 3), 15)], "at timestamp, m int")
    assert windows.overlaps(series, "at", "m").count() == 1
    late = spark.createDataFrame([(t(22, 0, 30 - 29), 60 * 27), (t(0, 15, 3), 15)], "at timestamp, m int")
    assert windows.overlaps(late, "at", "m").count() == 1  # into the next day that has rows
    fresh = lambda rows: quality.freshness(spark.createDataFrame(rows, "at timestamp, v double"), "at", "v", F.lit(t(4)).cast("timestamp"), 2.0).first().verdict
    assert [fresh(x) for x in ([], [(t(3), None)], [(t(1), 1.0), (t(3), None)], [(t(3), 1.0), (t(4), None)])] == ["vide", "sans_mesure", "en_retard", "ok"]


def test_regional_series_have_their_own_hours(spark):
    raw = spark.createDataFrame([(t, r, i) for i, (t, r) in enumerate([("2026-10-25T02:00", "84"), ("2026-10-25T02:00", "11"), ("2026-10-25T02:00", "84")])], "date_heure string, code_insee_region string, _seq long")
    got = conform(raw, REGIONAL_CONS_DEF, NOW).rows.orderBy("_seq").select(F.hour(F.col("date_heure"))).collect()
    assert [r[0] for r in got] == [0, 0, 1]


def test_bindings_match_sql(spark):
    """Every binding against its SQL on the smallest tables."""
    from gridmix import bindings, bindings_sql

    sf = "/root/testdata/sf0.001"
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    sql = bindings_sql.oracle_sql()
    plain = lambda rows: sorted(tuple("" if v is None else f"{v:.7g}" if isinstance(v, float) else str(v) for v in r) for r in rows)
    for name, f in bindings.queries().items():
        if name in sql:
            df = f(spark, sf)
            columns = ", ".join(f'"{x}"' for x in sorted(df.columns))
            want = c.sql(f"SELECT {columns} FROM ({sql[name]})").fetchall()
            assert plain(df.select(*sorted(df.columns)).collect()) == plain(want), name
