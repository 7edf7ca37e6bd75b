"""Expected figures of silver, gold, report and territory on the synthetic base."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridmix.plans import gold, report, silver, territory
from gridmix.sources.seeds import seed
from tests.energy import Base, one, table, utc
from gridmix.specs import NATIONAL_CONS_DEF

approx = pytest.approx


@pytest.fixture(scope="module")
def base(spark):
    return Base(spark)


def test_silver(base):
    assert (base.consolidated_bronze.count(), base.consolidated.count(), base.real_time.count()) == (196, 98, 23)
    later = base.mix.where("qualite = 'temps_reel'")
    assert later.count() == 15 and later.agg(F.min("date_heure") == utc(2026, 4, 30, 22)).first()[0]


def test_without_consolidated_rows(spark, base):
    none = silver.measured_series(table(spark, NATIONAL_CONS_DEF, []), 30, details=True)
    mix = silver.unified(none, base.real_time)
    assert mix.count() == 23 and mix.where("qualite <> 'temps_reel'").count() == 0


def test_daily_mix(base):
    d = one(base.daily, "jour = date'2024-10-27'")
    assert (d.qualite, d.nb_mesures, d.heures_couvertes, d.heures_du_jour, d.est_complet) == ("definitive", 50, 25.0, 25.0, True)
    assert (d.consommation_gwh, d.production_gwh, d.emissions_tco2) == (approx(1525), approx(1275), approx(42075))
    assert d.part_bas_carbone == approx(47500 / 51000) and d.taux_co2_moyen_g_kwh == approx(33)
    d = one(base.daily, "jour = date'2026-05-01'")
    assert (d.qualite, d.est_complet) == ("temps_reel", False)


def test_families(base):
    m = one(base.fct_mix, F.col("date_heure") == utc(2024, 10, 27, 12))
    p = {r.famille: r.s for r in base.production.where(F.col("date_heure") == utc(2024, 10, 27, 12)).groupBy("famille").agg(F.sum("production_mw").alias("s")).collect()}
    assert p == {"fossile": 3500.0, "nucleaire": 30000.0, "renouvelable": 17500.0}
    assert (m.production_totale_mw, m.production_fossile_mw, m.solde_echanges_mw) == (51000.0, 3500.0, -900.0)


def test_rows_without_sources_stay(spark, base):
    lone = base.mix.limit(1).select(*(F.lit(None).cast("double").alias(c) if c in ("nucleaire", "eolien", "solaire", "hydraulique", "gaz", "fioul", "charbon", "bioenergies") else F.col(c) for c in base.mix.columns))
    m = gold.mix_table(lone, gold.production_by_source(lone, seed(spark, "dim_filiere"))).first()
    assert m.production_totale_mw == 0 and m.part_bas_carbone is None


def test_hourly_slots(base):
    s = one(base.slots, F.col("heure_utc") == utc(2026, 4, 30, 3))
    assert (s.jour_tempo, s.couleur_tempo, s.periode_tarifaire, s.prix_ttc_eur_kwh) == (dt.date(2026, 4, 29), "blanc", "hc", 0.1499)
    s = one(base.slots, F.col("heure_utc") == utc(2026, 4, 30, 10))
    assert (s.couleur_tempo, s.periode_tarifaire, s.prix_ttc_eur_kwh) == ("rouge", "hp", 0.706)
    s = one(base.slots, F.col("heure_utc") == utc(2026, 4, 30, 21))
    assert (s.couleur_tempo, s.periode_tarifaire) == ("rouge", "hc")
    day = base.slots.where("jour = date'2024-10-27'")
    assert (day.count(), day.where("couleur_tempo is not null").count(), day.where("prix_ttc_eur_kwh is not null").count()) == (25, 25, 0)
    s = one(base.slots, F.col("heure_utc") == utc(2026, 4, 30, 15))
    assert (s.taux_co2_g_kwh, s.nb_mesures, s.est_complete) == (approx(95), 2, True)


def test_areas(base):
    of = {r.code_iris: r for r in base.areas.where("annee = 2020").collect()}
    assert {k: r.consommation_electricite_mwh for k, r in of.items()} == {"013760000": 6500.0, "692660000": 77000.0, "693830101": None}
    of = {r.code_iris: r for r in base.areas.where("annee = 2019").collect()}
    assert [(of[c].code_insee_commune, of[c].code_departement, of[c].code_insee_region) for c in ("020030000", "751010101")] == [("02003", "02", "32"), ("75056", "75", "11")]
    assert territory.reference_year(base.areas).first()[0] == 2019


def test_departments(base):
    ranked = {r.code_departement: (r.consommation_electricite_mwh, r.nb_sites_electricite, r.nb_communes_avec_site, r.rang_national) for r in base.departments.where("rang_national is not null").collect()}
    assert ranked == {"69": (83000.0, 3, 2, 1), "02": (9000.0, 1, 1, 2), "75": (4000.0, 1, 1, 3), "2A": (2500.0, 1, 1, 4)}
    assert base.departments.where("nb_departements_classes = 4").count() == 101
    assert base.diagnosis.count() == 101 and base.diagnosis.where("conso_industrielle_departement_gwh = 0").count() == 97


def test_regions(base):
    t = {r.code_insee_region: r for r in base.tension.collect()}
    assert len(t) == 18
    assert [(t[c].production_gwh, t[c].taux_couverture, t[c].statut_equilibre, t[c].rang_dependance) for c in ("11", "94", "84")] == [
        (approx(0.3), approx(25 / 120), "deficitaire", 1), (approx(0.72), approx(0.5), "deficitaire", 2), (approx(2.16), approx(1.5), "excedentaire", 3)]
    assert (t["84"].mois_debut, t["84"].mois_fin) == (dt.date(2024, 1, 1), dt.date(2024, 12, 1))
    assert (t["04"].nb_mois, t["04"].taux_couverture, t["04"].rang_dependance, t["04"].nb_regions_classees) == (0, None, None, 3)
    assert (t["84"].puissance_a_compenser_mw, t["84"].energie_non_evacuee_mwh) == (210.0, 1350.0)


def test_profile_cost(base):
    c = one(base.profile, F.col("heure_utc") == utc(2026, 4, 30, 8))
    assert (c.type_jour, c.periode_tarifaire, c.conso_kwh, c.conso_flexible_kwh) == ("ouvre", "hp", 28.0, 6.0)
    assert c.prix_htva_eur_kwh == approx(0.1351 + 0.03085) and c.emissions_kgco2 == approx(28 * 0.033)
    d = base.profile.where("jour = date'2024-10-27'").agg(F.count("*"), F.sum("conso_kwh"), F.count("prix_htva_eur_kwh"), F.max("type_jour")).first()
    assert tuple(d) == (25, 150.0, 0, "week_end")
    m = one(base.monthly, "mois = date'2026-04-01'")
    assert (m.kwh_decales, m.est_complet) == (24.0, False) and m.gain_decalage_eur == approx(24 * (0.1351 - 0.0989)) and m.co2_evite_kg == approx(0, abs=1e-9)
    m = one(base.monthly, "mois = date'2024-10-01'")
    assert (m.cout_htva_eur, m.gain_decalage_eur, m.est_complet, m.nb_heures_attendues) == (None, None, False, 745)


def test_report(spark, base):
    april = "mois = date'2026-04-01'"
    e = one(report.peak_episodes(base.slots), april)
    assert (e.nb_heures, e.co2_max, e.rang) == (2, approx(95), 1)
    h = one(report.coverage(base.slots, base.tempo), april)
    assert (h.heures_attendues, h.heures_completes, h.prix_disponibles, h.avis_couverture) == (720, 24, True, True)
    c = one(report.colour_counts(base.tempo), april)
    assert (c.jours_bleu, c.jours_blanc, c.jours_rouge) == (0, 1, 1) and c.jours_rouges_liste == [dt.date(2026, 4, 30)]
    best = report.best_windows(base.slots).where(april).orderBy("rang").collect()
    assert best[0].heure_paris == dt.datetime(2026, 4, 30) and (best[0].couleur_tempo, best[0].periode_tarifaire, best[0].prix_moyen) == ("blanc", "hc", approx(0.1499))
    assert one(report.worst_windows(base.slots), f"{april} and rang = 1").periode_tarifaire == "hp"
    for kept in (best, report.worst_windows(base.slots).where(april).collect()):
        starts = sorted(r.heure_utc for r in kept)
        assert all(b - a >= dt.timedelta(hours=3) for a, b in zip(starts, starts[1:]))
    s = one(report.flexible_saving(base.slots, kwh=10), april)
    assert (s.nb_jours, s.cout_optimise, s.cout_reference, s.co2_optimise_kg, s.co2_reference_kg) == (1, approx(1.499), approx(7.06), approx(0.33), approx(10 * (95 + 33 + 33) / 3 / 1000))
    october = "mois = date'2024-10-01'"
    assert (one(report.coverage(base.slots, base.tempo), october).heures_attendues, one(report.flexible_saving(base.slots), october).gain_eur) == (745, None)
    wide = one(report.heat_map(base.slots), "jour = date'2026-04-30'")
    assert wide.h18 == approx(95) and wide.h19 == approx(33)
    assert one(report.worst_days(base.slots, base.tempo), f"{april} and rang = 1").couleur == "rouge"
    t = report.tariff_summary(base.slots).where(april).orderBy("ordre").collect()
    assert [(r.couleur_tempo, r.periode_tarifaire) for r in t] == [("blanc", "hc"), ("rouge", "hc"), ("rouge", "hp")]


def test_sites(spark, base):
    rows = [(1, "69383", 0.009), (2, "75101", 0.036), (3, "99999", None), (4, "69266", 19.9), (5, "97411", 20.0), (6, "2A004", 39.9), (7, "01001", 40.0), (8, "01001", 1000.0), (9, "01001", 0.25)]
    sites = spark.createDataFrame(rows, "site_id long, code_insee_commune string, puissance_mw double")
    cost = territory.latest_priced_month(base.monthly.withColumn("est_complet", F.lit(True)), seed(spark, "profils_consommation"))
    found = {r.site_id: r for r in territory.site_diagnosis(sites, base.diagnosis, base.communes, seed(spark, "seuils_raccordement"), cost).collect()}
    assert len(found) == 9
    assert [found[i].code_commune for i in (1, 2, 4)] == ["69123", "75056", "69266"]
    assert [found[i].domaine_tension for i in range(1, 10)] == ["BT ≤ 36 kVA", "BT > 36 kVA", None, "HTA", "HTA – zone grise", "HTA – zone grise", "HTB", "HTB", "HTA"]
    assert found[3].departement_inconnu and not found[1].departement_inconnu and found[5].code_departement == "974"
    assert found[1].commune_a_des_sites and found[1].conso_industrielle_commune_gwh == approx(31.0) and not found[7].commune_a_des_sites
    assert found[1].cout_mois == dt.date(2026, 5, 1) or found[1].cout_mois == dt.date(2026, 4, 1)
    assert territory.site_limits(sites, seed(spark, "limites_methodologiques")).count() == 9 * 6
    with pytest.raises(Exception, match="negative power"):
        territory.connection_band(sites.withColumn("puissance_mw", F.lit(-1.0)), seed(spark, "seuils_raccordement")).collect()
