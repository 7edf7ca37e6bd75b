"""The stored build: equal to the products made directly, refreshed for the months that a change reaches, read by month."""

import datetime as dt
import random

import pytest

from gridmix.operators import upsert
from gridmix.plans import rebuild
from gridmix.specs import BALANCE, CONSTRAINTS, IRIS, NATIONAL_CONS_DEF, NATIONAL_TR, TEMPO
from tests.energy import CONSTANT, PARIS, UTC, Base, area_rows, balance_rows, consolidated_rows, constraint_rows, real_time_rows, table, tempo_rows

SCENARIO = {NATIONAL_CONS_DEF: consolidated_rows, NATIONAL_TR: real_time_rows, TEMPO: tempo_rows, IRIS: area_rows, BALANCE: balance_rows, CONSTRAINTS: constraint_rows}


def load(spark, base, spec, rows):
    return upsert.upsert(spark, base, spec, table(spark, spec, list(rows))).touched


def rows_of(df):
    names = sorted(df.columns)
    return sorted((tuple(round(v, 7) if isinstance(v, float) else str(v) for v in r) for r in df.select(*names).collect()), key=str)


def same(spark, one, other, names=None):
    for p in rebuild.PRODUCTS:
        if names is None or p.name in names:
            assert rows_of(rebuild.Store(spark, one).read(p.name)) == rows_of(rebuild.Store(spark, other).read(p.name)), p.name


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.glob("*/*/**/*.parquet") if "bronze" not in f.parts}


def test_months():
    assert rebuild.later({"2025-12"}, 1) == {"2025-12", "2026-01"} and rebuild.later({"2026-01"}, -2) == {"2025-11", "2025-12", "2026-01"}
    assert rebuild.between("2025-11", "2026-02") == {"2025-11", "2025-12", "2026-01", "2026-02"}
    assert {n for p in rebuild.PRODUCTS for n, _ in p.inputs} <= {*rebuild.BRONZE, *rebuild.BY_NAME} and len(rebuild.PRODUCTS) == 17


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("built")
    base = f"file://{at}"
    for spec, rows in SCENARIO.items():
        load(spark, base, spec, rows())
    assert list(rebuild.rebuild(spark, base)) == [p.name for p in rebuild.PRODUCTS]
    return at, base


def test_whole_build(spark, built):
    direct, store = Base(spark), rebuild.Store(spark, built[1])
    for name, df in {
        "mix_consolide": direct.consolidated, "mix_temps_reel": direct.real_time, "mix_unifie": direct.mix, "jours_tempo": direct.tempo, "production": direct.production, "mix": direct.fct_mix, "mix_journalier": direct.daily,
        "creneaux": direct.slots, "cout_horaire": direct.profile, "cout_mensuel": direct.monthly, "conso_industrielle": direct.areas, "pression_commune": direct.communes, "pression_departement": direct.departments,
        "tension_region": direct.tension, "territoire": direct.diagnosis,
    }.items():
        got = store.read(name)
        assert rows_of(got) == rows_of(df) and sorted(got.columns) == sorted(df.columns), name


def test_sections_read_their_months_only(spark, built):
    for name, (make, coloured) in rebuild.SECTIONS.items():
        part = rebuild.section(spark, built[1], name, "2026-04", "2026-04")
        plan = part._jdf.queryExecution().executedPlan().toString()
        filters = [x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:]]
        assert filters and all("_mois" in f and "2026-04" in f for f in filters), (name, filters)
        whole = rebuild.section(spark, built[1], name)
        assert rows_of(part) == rows_of(whole.where("mois = date'2026-04-01'")) and part.count(), name


def test_refresh_of_touched_months(spark, built, tmp_path):
    """A late revision, then consolidated rows that move the cut: each time the same as a whole build, and folders of
    months that aren't reached are not written."""
    at, base = built
    rng = random.Random(9)
    days = [dt.date(2026, 1, 15), dt.date(2026, 2, 28), dt.date(2026, 3, 29), dt.date(2026, 5, 31), dt.date(2026, 6, 10)]
    slots = lambda day, minutes: [dt.datetime.combine(day, dt.time(), PARIS).astimezone(UTC) + dt.timedelta(minutes=minutes * i) for i in range(24 * 60 // minutes)]
    noisy = lambda t, nature: {"date_heure": t, "nature": nature, **CONSTANT, "gaz": rng.uniform(1, 9000), "taux_co2": rng.uniform(10, 90)}
    changes = [
        {NATIONAL_TR: [noisy(t, "Données temps réel") for d in days[2:] for t in slots(d, 15)], TEMPO: [{"date_heure": slots(d, 60)[0], "couleur": "RED"} for d in days]},
        {NATIONAL_CONS_DEF: [noisy(t, "Données consolidées") for d in days[:3] for t in slots(d, 30)]},  # before the cut
        {NATIONAL_CONS_DEF: [noisy(slots(dt.date(2026, 6, 10), 30)[5], "Données consolidées")], IRIS: [{"annee": "2020", "code_iris": "692660000", "code_insee_commune": "69266", "consommation_electricite_rte": 5.0}]},
    ]
    for k, change in enumerate(changes):
        before = files(at)
        touched = {spec.table: set(load(spark, base, spec, rows)) for spec, rows in change.items()}
        done = rebuild.refresh(spark, base, touched)
        other = f"file://{tmp_path}/{k}"
        (tmp_path / str(k)).mkdir()
        (tmp_path / str(k) / "bronze").symlink_to(at / "bronze")
        rebuild.rebuild(spark, other)
        same(spark, base, other)
        after = files(at)
        kept = {f for f in before if before[f] == after.get(f)}
        assert {f for f in kept if "_mois=2024-10" in f} == {f for f in before if "_mois=2024-10" in f} != set()
        written = {f.split("/")[1] for f in after if f not in kept}
        assert written == set(done) and ("territoire" in done) == (IRIS in change)
        if k == 1:
            assert done["mix_consolide"] == {"2026-01", "2026-02", "2026-03"} and done["creneaux"] == {f"2026-0{m}" for m in range(1, 5)}
        if k == 2:  # real-time rows of May and June lie before the new cut: their folders are gone or smaller
            assert done["mix_unifie"] == {"2026-04", "2026-05", "2026-06"} and not list(at.glob("silver/mix_unifie/_mois=2026-05/*"))


def test_stream_to_gold(spark, built, tmp_path):
    """Landed files go through the upsert to the gold tables of the months they touch."""
    from gridmix.streaming.incremental import load_to_gold

    base = f"file://{tmp_path}"
    for spec, rows in SCENARIO.items():
        load(spark, base, spec, rows())
    rebuild.rebuild(spark, base)
    table(spark, NATIONAL_TR, [{"date_heure": dt.datetime(2026, 5, 20, 10, m, tzinfo=UTC), "nature": "Données temps réel", **CONSTANT} for m in (0, 15, 30, 45)]).write.parquet(f"{base}/landed")
    done = []
    load_to_gold(spark, base, NATIONAL_TR, f"{base}/landed", f"{base}/checkpoint", done.append).awaitTermination()
    assert [d["mix"] for d in done] == [{"2026-05", "2026-06"}]
    assert rebuild.Store(spark, base).read("creneaux").where("jour = date'2026-05-20'").count() == 1
