"""SQL for DuckDB that gives the same rows as ``bindings``: common table expressions by name, and a query per key."""

from __future__ import annotations

import re

from gridmix.bindings import FIGURES, REGION_CODES, SHIFT_DAYS
from gridmix.functions.text import MARKED, PLAIN
from gridmix.sources.seeds import SCHEMAS, rows_of
from gridmix.specs import DATASETS, SEASONS, SOURCES


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def _seed(name: str) -> str:
    columns = [c.strip().split(" ") for c in SCHEMAS[name].split(",")]
    kinds = {"string": "VARCHAR", "double": "DOUBLE", "int": "BIGINT", "boolean": "BOOLEAN", "date": "DATE"}
    rows = ", ".join(f"({', '.join(map(_literal, r))})" for r in rows_of(name))
    return f"SELECT {', '.join(f'{c}::{kinds[k]} AS {c}' for c, k in columns)} FROM (VALUES {rows}) AS v({', '.join(c for c, _ in columns)})"


def paris(ts: str) -> str:
    return f"timezone('Europe/Paris', timezone('UTC', {ts}))"


def utc(local: str) -> str:
    return f"timezone('UTC', timezone('Europe/Paris', {local}))"


def r6(x: str, name: str | None = None) -> str:
    return f"round({x}, 6) + 0 AS {name or x.split('.')[-1]}"


_regions = "[" + ", ".join(f"'{c}'" for c in REGION_CODES) + "]"
_own = ", ".join(f"sum(value) FILTER (WHERE user_id % 8 = {k}) AS {s}" for k, s in enumerate(SOURCES))


def _slots(minutes: int) -> str:
    us = minutes * 60_000_000
    return f"""SELECT date_heure, sum(value) AS consommation, avg(value) * 3 AS prevision_j1, max(value) * 2 AS prevision_j, {_own}, -min(value) AS pompage,
  max(value) - sum(value) AS ech_physiques, CASE WHEN count(*) % 11 <> 0 THEN avg(user_id % 97) END AS taux_co2
  FROM (SELECT make_timestamp((epoch_us(ts + INTERVAL {SHIFT_DAYS} DAY) // {us}) * {us}) AS date_heure, value, user_id FROM events) GROUP BY date_heure"""


_month_days = "date_diff('hour', {a}, {b})"


def month_hours(m: str) -> str:
    return f"date_diff('hour', {utc(f'({m})::TIMESTAMP')}, {utc(f'(({m}) + INTERVAL 1 MONTH)::TIMESTAMP')})"


_department = "CASE WHEN left({0}, 2) = '97' THEN left({0}, 3) ELSE left({0}, 2) END"
_city = "CASE left({0}, 3) WHEN '751' THEN '75056' WHEN '693' THEN '69123' WHEN '132' THEN '13055' END"
_normal = f"regexp_replace(lower(translate({{0}}, '{MARKED}', '{PLAIN}')), '[^a-z0-9]', '', 'g')"

CTE = {
    **{n: _seed(n) for n in SCHEMAS},
    "tr": f"SELECT *, 'temps_reel' AS qualite, 1::BIGINT AS rang_qualite, 15::BIGINT AS pas_minutes FROM ({_slots(15)}) WHERE date_heure >= TIMESTAMP '2026-04-10'",
    "cons": f"""SELECT *, CASE WHEN date_heure < TIMESTAMP '2026-04-05' THEN 'definitive' ELSE 'consolidee' END AS qualite,
  CASE WHEN date_heure < TIMESTAMP '2026-04-05' THEN 3::BIGINT ELSE 2::BIGINT END AS rang_qualite, 30::BIGINT AS pas_minutes FROM ({_slots(30)}) WHERE date_heure < TIMESTAMP '2026-04-16'""",
    "mix": "SELECT * FROM cons UNION ALL BY NAME SELECT * FROM tr WHERE date_heure >= (SELECT coalesce(max(date_heure) + INTERVAL 30 MINUTE, TIMESTAMP '1900-01-01') FROM cons)",
    "tempo": f"""SELECT j AS jour_tempo, CASE WHEN dayofyear(j) % 7 <= 4 THEN 'bleu' WHEN dayofyear(j) % 7 = 5 THEN 'blanc' ELSE 'rouge' END AS couleur
  FROM (SELECT DISTINCT (ts + INTERVAL {SHIFT_DAYS} DAY)::DATE AS j FROM events) WHERE dayofyear(j) % 7 <> 0""",
    "long": f"SELECT date_heure, qualite, pas_minutes, filiere, production_mw FROM (SELECT date_heure, qualite, pas_minutes, {', '.join(SOURCES)} FROM mix) UNPIVOT (production_mw FOR filiere IN ({', '.join(SOURCES)}))",
    "prod": f"SELECT l.*, d.libelle, d.famille, d.est_renouvelable, d.est_bas_carbone, {paris('date_heure')} AS date_heure_paris, {paris('date_heure')}::DATE AS jour, production_mw * pas_minutes / 60.0 AS energie_mwh FROM long l JOIN dim_filiere d USING (filiere)",
    "fam": """SELECT date_heure, sum(production_mw) AS a, sum(production_mw) FILTER (WHERE est_bas_carbone) AS b, sum(production_mw) FILTER (WHERE est_renouvelable) AS r,
  sum(production_mw) FILTER (WHERE famille = 'fossile') AS f FROM prod GROUP BY date_heure""",
    "fmix": f"""SELECT m.date_heure, {paris('m.date_heure')} AS date_heure_paris, {paris('m.date_heure')}::DATE AS jour, qualite, rang_qualite, pas_minutes, consommation AS consommation_mw, prevision_j1 AS prevision_j1_mw,
  prevision_j AS prevision_j_mw, consommation - prevision_j1 AS ecart_prevision_j1_mw, {', '.join(f'{s} AS {s}_mw' for s in SOURCES)}, pompage AS pompage_mw, coalesce(a, 0) AS production_totale_mw,
  coalesce(b, 0) AS production_bas_carbone_mw, coalesce(r, 0) AS production_renouvelable_mw, coalesce(f, 0) AS production_fossile_mw, b / nullif(a, 0) AS part_bas_carbone, r / nullif(a, 0) AS part_renouvelable,
  ech_physiques AS solde_echanges_mw, taux_co2 AS taux_co2_g_kwh FROM mix m LEFT JOIN fam USING (date_heure)""",
    "hours0": """SELECT date_trunc('hour', date_heure) AS heure_utc, count(*) AS nb_mesures, sum(pas_minutes) AS minutes, avg(consommation_mw) AS consommation_mw,
  sum(taux_co2_g_kwh * production_totale_mw) / nullif(sum(production_totale_mw) FILTER (WHERE taux_co2_g_kwh IS NOT NULL), 0) AS taux_co2_g_kwh,
  avg(part_bas_carbone) AS part_bas_carbone, avg(part_renouvelable) AS part_renouvelable FROM fmix GROUP BY 1""",
    "hours1": f"SELECT *, {paris('heure_utc')} AS heure_paris FROM hours0",
    "hours2": """SELECT *, heure_paris::DATE AS jour, hour(heure_paris) AS heure_locale, CASE WHEN hour(heure_paris) >= 22 OR hour(heure_paris) < 6 THEN 'hc' ELSE 'hp' END AS periode_tarifaire,
  CASE WHEN hour(heure_paris) < 6 THEN heure_paris::DATE - 1 ELSE heure_paris::DATE END AS jour_tempo FROM hours1""",
    "h": """SELECT h.heure_utc, h.heure_paris, h.jour, date_trunc('month', h.jour)::DATE AS mois, h.heure_locale, isodow(h.jour) AS jour_semaine, h.jour_tempo, t.couleur AS couleur_tempo, h.periode_tarifaire,
  g.prix_ttc_eur_kwh, h.taux_co2_g_kwh, h.consommation_mw, h.part_bas_carbone, h.part_renouvelable, h.nb_mesures, h.minutes >= 60 AS est_complete
  FROM hours2 h LEFT JOIN tempo t USING (jour_tempo) LEFT JOIN tarifs_tempo g ON g.couleur = t.couleur AND g.periode = h.periode_tarifaire AND h.jour >= g.date_debut AND h.jour < coalesce(g.date_fin, DATE '9999-12-31')""",
    "ph": """SELECT p.profil, h.heure_utc, h.jour, h.mois, h.heure_locale, p.type_jour, h.periode_tarifaire, h.est_complete, p.puissance_kw AS conso_kwh, p.puissance_flexible_kw AS conso_flexible_kwh,
  g.prix_ht_eur_kwh + g.accise_eur_kwh AS prix_htva_eur_kwh, p.puissance_kw * (g.prix_ht_eur_kwh + g.accise_eur_kwh) AS cout_htva_eur, h.taux_co2_g_kwh, p.puissance_kw * h.taux_co2_g_kwh / 1000 AS emissions_kgco2
  FROM h JOIN profils_consommation p ON p.type_jour = CASE WHEN jour_semaine <= 5 THEN 'ouvre' ELSE 'week_end' END AND h.heure_locale >= p.heure_debut AND h.heure_locale < p.heure_fin
  LEFT JOIN tarifs_hphc g ON g.periode = h.periode_tarifaire AND h.jour >= g.date_debut AND h.jour < coalesce(g.date_fin, DATE '9999-12-31')""",
    "pd": """SELECT profil, mois, jour, sum(conso_flexible_kwh) FILTER (WHERE periode_tarifaire = 'hp') AS k, sum(conso_flexible_kwh * prix_htva_eur_kwh) FILTER (WHERE periode_tarifaire = 'hp') AS c,
  sum(conso_flexible_kwh * taux_co2_g_kwh) FILTER (WHERE periode_tarifaire = 'hp') / 1000 AS e, max(prix_htva_eur_kwh) FILTER (WHERE periode_tarifaire = 'hc') AS p, avg(taux_co2_g_kwh) FILTER (WHERE periode_tarifaire = 'hc') AS r
  FROM ph GROUP BY ALL""",
    "pm": f"""SELECT m.profil, m.mois, nb_heures, {month_hours('m.mois')} AS nb_heures_attendues, entier AND nb_heures = {month_hours('m.mois')} AS est_complet, conso_kwh, hc / conso_kwh AS part_hc,
  CASE WHEN tarife THEN cout END AS cout_htva_eur, CASE WHEN tarife THEN cout / conso_kwh END AS prix_moyen_htva_eur_kwh, emissions_kgco2, emissions_kgco2 * 1000 / conso_kwh AS intensite_moyenne_g_kwh, kwh_decales,
  CASE WHEN tarife THEN gain END AS gain_decalage_eur, co2_evite_kg
  FROM (SELECT profil, mois, count(*) AS nb_heures, bool_and(est_complete) AS entier, sum(conso_kwh) AS conso_kwh, sum(conso_kwh) FILTER (WHERE periode_tarifaire = 'hc') AS hc, count(prix_htva_eur_kwh) = count(*) AS tarife,
    sum(cout_htva_eur) AS cout, sum(emissions_kgco2) AS emissions_kgco2 FROM ph GROUP BY ALL) m
  JOIN (SELECT profil, mois, sum(k) AS kwh_decales, sum(c - k * p) AS gain, sum(e - k * r / 1000) AS co2_evite_kg FROM pd GROUP BY ALL) g ON g.profil = m.profil AND g.mois = m.mois""",
    "seuil": "SELECT mois, quantile_cont(taux_co2_g_kwh, 0.9) AS seuil_pic FROM h GROUP BY mois",
    "fen": """SELECT *, avg(prix_ttc_eur_kwh) OVER w AS prix_moyen, avg(taux_co2_g_kwh) OVER w AS co2_moyen, count(taux_co2_g_kwh) OVER w AS nb, count(prix_ttc_eur_kwh) OVER w AS np, last_value(heure_utc) OVER w AS fin,
  (count(prix_ttc_eur_kwh) OVER (PARTITION BY mois)) > 0 AS avec FROM h WINDOW w AS (PARTITION BY mois ORDER BY heure_utc ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)""",
    "cand": "SELECT *, CASE WHEN avec THEN prix_moyen ELSE 0 END AS cle FROM fen WHERE nb = 3 AND fin = heure_utc + INTERVAL 2 HOUR AND (NOT avec OR np = 3)",
    # territory
    "b_iris": """SELECT annee, code_iris, pub AS code_insee_commune, max(com) AS commune, sum(kwh) AS conso, sum(pdl)::DOUBLE AS pdl FROM (
  SELECT (2020 + c_custkey % 3)::VARCHAR AS annee, CASE WHEN lost THEN substr(iris, 2, 8) ELSE iris END AS code_iris, CASE WHEN NOT lost THEN commune END AS pub, CASE WHEN NOT lost THEN 'C' || commune END AS com,
    CASE WHEN c_acctbal >= 0 OR c_custkey % 3 < 2 THEN abs(c_acctbal) END AS kwh, c_custkey % 4 AS pdl
  FROM (SELECT *, commune || lpad((c_custkey % 40)::VARCHAR, 4, '0') AS iris FROM (
    SELECT *, lpad((c_nationkey + 1)::VARCHAR, 2, '0') || lpad((c_custkey % 60)::VARCHAR, 3, '0') AS commune, c_custkey % 10 = 0 AND c_nationkey < 9 AS lost FROM customer WHERE c_nationkey <> 19))) GROUP BY ALL""",
    "iris0": """SELECT *, lpad(code_iris, 9, '0') AS iris, row_number() OVER (PARTITION BY annee, lpad(code_iris, 9, '0') ORDER BY length(code_iris) DESC, conso DESC NULLS LAST) AS rn FROM b_iris""",
    "iris1": f"SELECT *, coalesce(code_insee_commune, {_city.format('iris')}, left(iris, 5)) AS com FROM iris0 WHERE rn = 1",
    "areas": f"""SELECT annee::BIGINT AS annee, iris AS code_iris, com AS code_insee_commune, commune, code_insee_commune IS NULL AS est_commune_reconstituee, {_department.format('com')} AS code_departement,
  d.code_insee_region, conso AS consommation_electricite_mwh, pdl AS nb_sites_electricite, conso IS NULL AS est_secret FROM iris1 LEFT JOIN dim_departement d ON d.code_departement = {_department.format('com')}""",
    "ref": "SELECT coalesce(max(annee) FILTER (WHERE NOT masque), max(annee)) AS annee FROM (SELECT annee, bool_or(est_secret) AS masque FROM areas GROUP BY annee)",
    "communes": """SELECT annee, code_insee_commune, min(commune) AS commune, min(code_departement) AS code_departement, min(code_insee_region) AS code_insee_region, coalesce(sum(consommation_electricite_mwh), 0) AS consommation_electricite_mwh,
  coalesce(sum(nb_sites_electricite), 0)::BIGINT AS nb_sites_electricite, count(*) AS nb_iris, count(*) FILTER (WHERE est_secret) AS nb_iris_secret, bool_or(est_secret) AS est_minorant FROM areas JOIN ref USING (annee) GROUP BY ALL""",
    "dep0": """SELECT code_departement, sum(consommation_electricite_mwh) AS mwh, sum(nb_sites_electricite) AS s, count(DISTINCT code_insee_commune) FILTER (WHERE nb_sites_electricite > 0) AS c, count(*) FILTER (WHERE est_secret) AS x
  FROM areas JOIN ref USING (annee) GROUP BY 1""",
    "dep1": """SELECT annee, d.code_departement, departement, code_insee_region, coalesce(mwh, 0) AS consommation_electricite_mwh, coalesce(s, 0)::BIGINT AS nb_sites_electricite, coalesce(c, 0)::BIGINT AS nb_communes_avec_site,
  coalesce(x, 0)::BIGINT AS nb_iris_secret, coalesce(x, 0) > 0 AS est_minorant FROM dim_departement d CROSS JOIN ref LEFT JOIN dep0 USING (code_departement)""",
    "dep": """SELECT *, CASE WHEN consommation_electricite_mwh > 0 THEN rank() OVER (PARTITION BY consommation_electricite_mwh > 0 ORDER BY consommation_electricite_mwh DESC) END AS rang_national,
  count(*) FILTER (WHERE consommation_electricite_mwh > 0) OVER () AS nb_departements_classes FROM dep1""",
    "bal": f"""SELECT date_trunc('month', o_orderdate)::DATE AS mois, reg AS code_insee_region, sum(o_totalprice * 2) FILTER (WHERE o_orderstatus = 'F') AS production_totale_mwh, sum(o_totalprice) AS consommation_brute_mwh,
  min(o_totalprice) AS pompage_mwh, max(o_totalprice) AS solde_echanges_physiques_mwh FROM (SELECT *, {_regions}[(o_custkey % 13 + 1)::INT] AS reg FROM orders) WHERE reg IS NOT NULL GROUP BY 1, 2""",
    "contr": f"""SELECT r.code_insee_region, coalesce(upper(r.region), 'ATLANTIDE') AS libelle_publie, a AS puissance_enr_installee_mw, b AS puissance_a_compenser_mw, {', '.join(f'b + {i} AS energie_non_evacuee_{x}_mwh' for i, x in enumerate(SEASONS))}
  FROM (SELECT s_suppkey % 9 + 1 AS k, sum(s_acctbal) AS a, max(s_acctbal) AS b FROM supplier GROUP BY 1) s LEFT JOIN dim_region r ON s.k <= 8 AND r.code_insee_region = {_regions}[s.k::INT]""",
    "bounds": "SELECT (max(mois) - INTERVAL 11 MONTH)::DATE AS mois_debut, max(mois) AS mois_fin FROM bal",
    "tens0": """SELECT r.*, mois_debut, mois_fin, coalesce(n, 0)::BIGINT AS nb_mois, p / 1000 AS production_gwh, c / 1000 AS consommation_gwh, (p - c) / 1000 AS solde_gwh, p / nullif(c, 0) AS taux_couverture, puissance_enr_installee_mw,
  puissance_a_compenser_mw, energie_non_evacuee_printemps_mwh + energie_non_evacuee_ete_mwh + energie_non_evacuee_automne_mwh + energie_non_evacuee_hiver_mwh AS energie_non_evacuee_mwh
  FROM dim_region r CROSS JOIN bounds LEFT JOIN (SELECT code_insee_region, count(*) AS n, sum(production_totale_mwh) AS p, sum(consommation_brute_mwh) AS c FROM bal, bounds WHERE mois BETWEEN mois_debut AND mois_fin GROUP BY 1) USING (code_insee_region)
  LEFT JOIN contr USING (code_insee_region)""",
    "tens": """SELECT * EXCLUDE (libelle_publie), CASE WHEN taux_couverture >= 1 THEN 'excedentaire' WHEN taux_couverture < 1 THEN 'deficitaire' END AS statut_equilibre,
  CASE WHEN taux_couverture IS NOT NULL THEN rank() OVER (PARTITION BY taux_couverture IS NULL ORDER BY taux_couverture) END AS rang_dependance, count(taux_couverture) OVER () AS nb_regions_classees
  FROM (SELECT *, NULL AS libelle_publie FROM tens0)""",
    "terr": """SELECT d.code_departement, d.departement, d.code_insee_region, d.annee AS annee_pression, d.consommation_electricite_mwh / 1000 AS conso_industrielle_departement_gwh, d.nb_sites_electricite AS nb_sites_departement, d.nb_communes_avec_site,
  d.est_minorant AS conso_departement_est_minorant, d.rang_national AS rang_pression_departement, d.nb_departements_classes, t.region, t.est_zni, t.mois_debut AS equilibre_mois_debut, t.mois_fin AS equilibre_mois_fin, t.nb_mois AS equilibre_nb_mois,
  t.production_gwh AS production_region_gwh, t.consommation_gwh AS consommation_region_gwh, t.solde_gwh AS solde_region_gwh, t.taux_couverture AS taux_couverture_region, t.statut_equilibre, t.rang_dependance AS rang_dependance_region,
  t.nb_regions_classees, t.puissance_enr_installee_mw, t.puissance_a_compenser_mw, t.energie_non_evacuee_mwh FROM dep d JOIN tens t USING (code_insee_region)""",
    "sites": """SELECT s_suppkey AS site_id, CASE s_suppkey % 7 WHEN 0 THEN '75101' WHEN 1 THEN '99001' ELSE lpad((s_nationkey + 1)::VARCHAR, 2, '0') || lpad((s_suppkey % 60)::VARCHAR, 3, '0') END AS code_insee_commune,
  CASE WHEN s_suppkey % 5 <> 0 THEN abs(s_acctbal) / 200 END AS puissance_mw FROM supplier""",
    "sites1": f"SELECT *, CASE WHEN length(code_insee_commune) = 5 THEN coalesce({_city.format('code_insee_commune')}, code_insee_commune) ELSE code_insee_commune END AS code_commune FROM sites",
    "cout": """SELECT mois AS cout_mois, 'Bureau tertiaire, 36 kVA' AS cout_profil_libelle, conso_kwh AS cout_conso_kwh, part_hc AS cout_part_hc, cout_htva_eur AS cout_cout_htva_eur, prix_moyen_htva_eur_kwh AS cout_prix_moyen_htva_eur_kwh,
  intensite_moyenne_g_kwh AS cout_intensite_moyenne_g_kwh, kwh_decales AS cout_kwh_decales, gain_decalage_eur AS cout_gain_decalage_eur, co2_evite_kg AS cout_co2_evite_kg FROM pm WHERE cout_htva_eur IS NOT NULL ORDER BY mois DESC LIMIT 1""",
    # operators
    "rec": """SELECT o_orderkey AS k, o_orderkey % 2 = 0 AS aware, o_orderdate::DATE + (o_orderkey % 24) * INTERVAL 1 HOUR + INTERVAL 30 MINUTE AS t, o_orderpriority, o_totalprice FROM orders""",
    "batch": """SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice, 1 AS version, o_orderkey AS seq FROM orders WHERE o_orderstatus <> 'F'
  UNION ALL SELECT o_orderkey, NULL, o_totalprice + 2, CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 1 END, o_orderkey + 1 FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 2 = 0
  UNION ALL SELECT -o_orderkey, o_custkey, o_totalprice + 1, 1, o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 5 = 0""",
    "latest": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC, (o_custkey IS NOT NULL)::INT + (o_totalprice IS NOT NULL)::INT DESC, seq DESC) AS rn FROM batch) WHERE rn = 1""",
}


def _greedy(order: str, k: int, sense: str) -> str:
    return f"""SELECT '{sense}' AS sens, rk.* FROM (
  WITH RECURSIVE r AS (SELECT *, row_number() OVER (PARTITION BY mois ORDER BY {order}, heure_utc) AS rk FROM cand),
  g AS (SELECT DISTINCT mois, 0::BIGINT AS rk, []::TIMESTAMP[] AS kept FROM cand UNION ALL
    SELECT g.mois, r.rk, CASE WHEN len(kept) < {k} AND len(list_filter(kept, lambda a: a < r.heure_utc + INTERVAL 3 HOUR AND r.heure_utc < a + INTERVAL 3 HOUR)) = 0 THEN list_append(kept, r.heure_utc) ELSE kept END
    FROM g JOIN r ON r.mois = g.mois AND r.rk = g.rk + 1),
  last AS (SELECT mois, arg_max(kept, rk) AS kept FROM g GROUP BY mois)
  SELECT r.mois, list_position(kept, r.heure_utc)::BIGINT AS rang, r.heure_utc, r.heure_paris, {r6('r.prix_moyen')}, {r6('r.co2_moyen')}, r.couleur_tempo, r.periode_tarifaire FROM r JOIN last USING (mois) WHERE list_contains(kept, r.heure_utc)) rk"""


def _rounded(names: str) -> str:
    return ", ".join(r6(n) for n in names.split())


_mix_doubles = "consommation_mw prevision_j1_mw prevision_j_mw ecart_prevision_j1_mw " + " ".join(f"{s}_mw" for s in SOURCES) + " pompage_mw production_totale_mw production_bas_carbone_mw production_renouvelable_mw production_fossile_mw part_bas_carbone part_renouvelable solde_echanges_mw taux_co2_g_kwh"
_series = f"date_heure, qualite, rang_qualite, pas_minutes, {_rounded('consommation prevision_j1 prevision_j ' + ' '.join(SOURCES) + ' pompage ech_physiques taux_co2')}"
_terr_doubles = "conso_industrielle_departement_gwh production_region_gwh consommation_region_gwh solde_region_gwh taux_couverture_region puissance_enr_installee_mw puissance_a_compenser_mw energie_non_evacuee_mwh"
_terr_rest = "departement, code_insee_region, annee_pression, nb_sites_departement, nb_communes_avec_site, conso_departement_est_minorant, rang_pression_departement, nb_departements_classes, region, est_zni, equilibre_mois_debut, equilibre_mois_fin, equilibre_nb_mois, statut_equilibre, rang_dependance_region, nb_regions_classees"
_cost_doubles = "cout_conso_kwh cout_part_hc cout_cout_htva_eur cout_prix_moyen_htva_eur_kwh cout_intensite_moyenne_g_kwh cout_kwh_decales cout_gain_decalage_eur cout_co2_evite_kg"

QUERY = {
    "m11_hourly_slots": f"SELECT heure_utc, heure_paris, jour, mois, heure_locale, jour_semaine, jour_tempo, couleur_tempo, periode_tarifaire, nb_mesures, est_complete, {_rounded('prix_ttc_eur_kwh taux_co2_g_kwh consommation_mw part_bas_carbone part_renouvelable')} FROM h",
    "m1_real_time": f"SELECT {_series} FROM tr",
    "m2_consolidated": f"SELECT {_series} FROM cons",
    "m3_unified": f"SELECT date_heure, qualite, rang_qualite, pas_minutes, {_rounded('consommation ' + ' '.join(SOURCES) + ' taux_co2')} FROM mix",
    "m4_tempo_days": "SELECT * FROM tempo",
    "m5_areas": f"SELECT * EXCLUDE (consommation_electricite_mwh), {r6('consommation_electricite_mwh')} FROM areas",
    "m6_balance": f"SELECT mois, code_insee_region, {_rounded('production_totale_mwh consommation_brute_mwh pompage_mwh solde_echanges_physiques_mwh')} FROM bal",
    "m7_constraints": f"SELECT code_insee_region, libelle_publie, {_rounded('puissance_enr_installee_mw puissance_a_compenser_mw ' + ' '.join(f'energie_non_evacuee_{x}_mwh' for x in SEASONS))} FROM contr",
    "m8_production": f"SELECT date_heure, date_heure_paris, jour, qualite, pas_minutes, filiere, libelle, famille, est_renouvelable, est_bas_carbone, {_rounded('production_mw energie_mwh')} FROM prod",
    "m9_mix": f"SELECT date_heure, date_heure_paris, jour, qualite, rang_qualite, pas_minutes, {_rounded(_mix_doubles)} FROM fmix",
    "m10_daily_mix": f"""SELECT jour, qualite, nb_mesures, {_rounded('heures_couvertes heures_du_jour')}, heures_couvertes >= heures_du_jour AS est_complet, {_rounded('consommation_gwh pointe_consommation_mw creux_consommation_mw production_gwh ' + ' '.join(f'{s}_gwh' for s in SOURCES) + ' part_bas_carbone part_renouvelable solde_echanges_gwh emissions_tco2 taux_co2_moyen_g_kwh')}
      FROM (SELECT *, date_diff('minute', {utc('jour::TIMESTAMP')}, {utc('(jour + 1)::TIMESTAMP')}) / 60.0 AS heures_du_jour FROM (
        SELECT jour, arg_min(qualite, rang_qualite) AS qualite, count(*) AS nb_mesures, sum(w)::DOUBLE AS heures_couvertes, sum(consommation_mw * w) / 1000 AS consommation_gwh, max(consommation_mw) AS pointe_consommation_mw, min(consommation_mw) AS creux_consommation_mw,
          sum(production_totale_mw * w) / 1000 AS production_gwh, {', '.join(f'sum(coalesce({s}_mw, 0) * w) / 1000 AS {s}_gwh' for s in SOURCES)}, sum(production_bas_carbone_mw * w) / nullif(sum(production_totale_mw * w), 0) AS part_bas_carbone,
          sum(production_renouvelable_mw * w) / nullif(sum(production_totale_mw * w), 0) AS part_renouvelable, sum(solde_echanges_mw * w) / 1000 AS solde_echanges_gwh, sum(taux_co2_g_kwh * production_totale_mw * w) / 1000 AS emissions_tco2,
          sum(taux_co2_g_kwh * production_totale_mw * w) / nullif(sum(production_totale_mw * w) FILTER (WHERE taux_co2_g_kwh IS NOT NULL), 0) AS taux_co2_moyen_g_kwh
        FROM (SELECT *, (pas_minutes / 60.0)::DOUBLE AS w FROM fmix) GROUP BY jour))""",
    "m12_profile_hours": f"SELECT profil, heure_utc, jour, mois, heure_locale, type_jour, periode_tarifaire, est_complete, {_rounded('conso_kwh conso_flexible_kwh prix_htva_eur_kwh cout_htva_eur taux_co2_g_kwh emissions_kgco2')} FROM ph",
    "m13_profile_months": f"SELECT profil, mois, nb_heures, nb_heures_attendues, est_complet, {_rounded('conso_kwh part_hc cout_htva_eur prix_moyen_htva_eur_kwh emissions_kgco2 intensite_moyenne_g_kwh kwh_decales gain_decalage_eur co2_evite_kg')} FROM pm",
    "m14_commune_pressure": f"SELECT * EXCLUDE (consommation_electricite_mwh), {r6('consommation_electricite_mwh')} FROM communes",
    "m15_department_pressure": f"SELECT * EXCLUDE (consommation_electricite_mwh), {r6('consommation_electricite_mwh')} FROM dep",
    "m16_region_tension": f"SELECT code_insee_region, region, est_zni, mois_debut, mois_fin, nb_mois, {_rounded('production_gwh consommation_gwh solde_gwh taux_couverture puissance_enr_installee_mw puissance_a_compenser_mw energie_non_evacuee_mwh')}, statut_equilibre, rang_dependance, nb_regions_classees FROM tens",
    "m17_territory": f"SELECT code_departement, {_terr_rest}, {_rounded(_terr_doubles)} FROM terr",
    "m18_sites": f"""SELECT site_id, s.code_insee_commune, {r6('s.puissance_mw')}, code_commune, {_department.format('code_commune')} AS code_departement, {_terr_rest.replace('code_insee_region', 't.code_insee_region')}, {', '.join(r6(f't.{n}') for n in _terr_doubles.split())},
      c.commune, {r6('c.consommation_electricite_mwh / 1000', 'conso_industrielle_commune_gwh')}, c.nb_sites_electricite AS nb_sites_commune, c.est_minorant AS conso_commune_est_minorant, t.departement IS NULL AS departement_inconnu,
      coalesce(c.nb_sites_electricite > 0, false) AS commune_a_des_sites, b.domaine_tension, b.gestionnaire, b.commentaire, cout_mois, cout_profil_libelle, {_rounded(_cost_doubles)}
      FROM sites1 s LEFT JOIN terr t ON t.code_departement = {_department.format('code_commune')} LEFT JOIN communes c ON c.code_insee_commune = s.code_commune
      LEFT JOIN seuils_raccordement b ON s.puissance_mw >= b.puissance_min_mw AND (b.puissance_max_mw IS NULL OR s.puissance_mw < b.puissance_max_mw) LEFT JOIN cout ON true""",
    "m18_site_limits": "SELECT site_id, indicateur, source, maille, millesime FROM sites CROSS JOIN limites_methodologiques",
    "m19_carbon_summary": f"""SELECT mois, {r6('avg(taux_co2_g_kwh)', 'co2_moyen')}, (min({{'r': taux_co2_g_kwh, 't': heure_utc}})).t AS heure_plus_propre, {r6('min(taux_co2_g_kwh)', 'co2_min')}, (min({{'r': -taux_co2_g_kwh, 't': heure_utc}})).t AS heure_plus_carbonee,
      {r6('max(taux_co2_g_kwh)', 'co2_max')}, {r6('quantile_cont(taux_co2_g_kwh, 0.9)', 'seuil_pic')} FROM h WHERE taux_co2_g_kwh IS NOT NULL GROUP BY mois""",
    "m19_peak_hours": f"SELECT mois, heure_utc, {_rounded('taux_co2_g_kwh seuil_pic')}, coalesce(taux_co2_g_kwh > seuil_pic, false) AS est_pic FROM h JOIN seuil USING (mois)",
    "m19_episodes": f"""SELECT mois, debut_utc, fin_utc, nb_heures, {_rounded('co2_max co2_moyen')}, rang FROM (SELECT *, row_number() OVER (PARTITION BY mois ORDER BY co2_max DESC, debut_utc) AS rang FROM (
      SELECT mois, min(heure_utc) AS debut_utc, max(heure_utc) + INTERVAL 1 HOUR AS fin_utc, count(*) AS nb_heures, max(taux_co2_g_kwh) AS co2_max, avg(taux_co2_g_kwh) AS co2_moyen
      FROM (SELECT *, heure_utc - to_hours(row_number() OVER (PARTITION BY mois ORDER BY heure_utc)) AS ilot FROM h JOIN seuil USING (mois) WHERE taux_co2_g_kwh > seuil_pic) GROUP BY mois, ilot)) WHERE rang <= 8""",
    "m19_worst_days": f"""SELECT mois, rang, jour, {r6('co2_moyen')}, coalesce(couleur, 'inconnue') AS couleur FROM (SELECT *, row_number() OVER (PARTITION BY mois ORDER BY co2_moyen DESC, jour) AS rang FROM (
      SELECT mois, jour, avg(taux_co2_g_kwh) AS co2_moyen FROM h WHERE taux_co2_g_kwh IS NOT NULL GROUP BY ALL)) LEFT JOIN tempo ON jour_tempo = jour WHERE rang <= 5""",
    "m20_tariffs": f"""SELECT mois, couleur_tempo, periode_tarifaire, count(*) AS nb_heures, {r6('avg(prix_ttc_eur_kwh)', 'prix_moyen')}, {r6('avg(taux_co2_g_kwh)', 'co2_moyen')},
      (list_position(['bleu', 'blanc', 'rouge'], couleur_tempo) * 2 + (periode_tarifaire = 'hp')::INT)::BIGINT AS ordre FROM h WHERE couleur_tempo IS NOT NULL GROUP BY mois, couleur_tempo, periode_tarifaire""",
    "m20_hour_profile": f"SELECT mois, heure_locale, {r6('avg(taux_co2_g_kwh)', 'co2_moyen')}, {r6('avg(prix_ttc_eur_kwh)', 'prix_moyen')} FROM h GROUP BY mois, heure_locale",
    "m20_colours": """SELECT date_trunc('month', jour_tempo)::DATE AS mois, count(*) FILTER (WHERE couleur = 'bleu') AS jours_bleu, count(*) FILTER (WHERE couleur = 'blanc') AS jours_blanc, count(*) FILTER (WHERE couleur = 'rouge') AS jours_rouge,
      coalesce(string_agg(jour_tempo::VARCHAR, ',' ORDER BY jour_tempo) FILTER (WHERE couleur = 'rouge'), '') AS jours_rouges_liste FROM tempo GROUP BY 1""",
    "m21_windows": f"SELECT * FROM ({_greedy('cle, co2_moyen', 5, 'meilleur')}) UNION ALL SELECT * FROM ({_greedy('cle DESC, co2_moyen DESC', 3, 'pire')})",
    "m22_saving": f"""SELECT mois, count(*) AS nb_jours, {r6('sum(p1) * 7', 'cout_optimise')}, {r6('sum(p2) * 7', 'cout_reference')}, {r6('sum(c1) * 7 / 1000', 'co2_optimise_kg')}, {r6('sum(c2) * 7 / 1000', 'co2_reference_kg')},
      {r6('sum(p2) * 7 - sum(p1) * 7', 'gain_eur')}, {r6('sum(c2) * 7 / 1000 - sum(c1) * 7 / 1000', 'gain_co2_kg')}
      FROM (SELECT mois, jour, prix_moyen AS p1, co2_moyen AS c1 FROM cand QUALIFY row_number() OVER (PARTITION BY mois, jour ORDER BY cle, co2_moyen, heure_utc) = 1)
      JOIN (SELECT mois, jour, prix_moyen AS p2, co2_moyen AS c2 FROM cand WHERE heure_locale = 18 QUALIFY row_number() OVER (PARTITION BY mois, jour ORDER BY heure_utc) = 1) USING (mois, jour) GROUP BY mois""",
    "m23_coverage": f"""SELECT *, couverture < 0.98 AS avis_couverture, jours_tempo_connus < jours_du_mois AS avis_couleurs, NOT prix_disponibles AS avis_prix FROM (SELECT mois, {month_hours('mois')} AS heures_attendues, heures_completes, day(last_day(mois)) AS jours_du_mois,
      coalesce(k, 0) AS jours_tempo_connus, prix_disponibles, a_des_donnees, {r6(f'heures_completes / {month_hours("mois")}', 'couverture')}
      FROM (SELECT mois, count(*) FILTER (WHERE est_complete) AS heures_completes, count(prix_ttc_eur_kwh) > 0 AS prix_disponibles, count(taux_co2_g_kwh) > 0 AS a_des_donnees FROM h GROUP BY mois)
      LEFT JOIN (SELECT date_trunc('month', jour_tempo)::DATE AS mois, count(*) AS k FROM tempo WHERE couleur IS NOT NULL GROUP BY 1) USING (mois))""",
    "m24_heat_map": f"SELECT mois, jour, {', '.join(r6(f'max(taux_co2_g_kwh) FILTER (WHERE heure_locale = {i})', f'h{i:02d}') for i in range(24))} FROM h GROUP BY mois, jour",
    "p1_conform": f"""SELECT CASE WHEN aware THEN t ELSE {utc('t')} END AS o_orderdate, k::VARCHAR AS o_orderkey, trim(o_orderpriority) AS o_orderpriority, NULL::VARCHAR AS absent, CASE WHEN k % 13 <> 0 AND k % 17 <> 0 THEN round(o_totalprice, 2) END AS o_totalprice,
      NULL::DOUBLE AS o_clerk_score, TIMESTAMP '2026-07-01 03:00:00' AS ingested_at_utc, 'orders_text' AS source_dataset FROM rec WHERE k % 19 <> 0 AND (aware OR {paris(utc('t'))} = t)""",
    "p8_rejects": f"SELECT k AS seq, 'illisible' AS motif FROM rec WHERE k % 13 = 0 UNION ALL SELECT k, 'sans_cle' FROM rec WHERE k % 19 = 0 AND (aware OR {paris(utc('t'))} = t) UNION ALL SELECT k, 'heure_inexistante' FROM rec WHERE NOT aware AND {paris(utc('t'))} <> t",
    "p11_civil_calendar": f"""SELECT jour, date_diff('minute', {utc('jour::TIMESTAMP')}, {utc('(jour + 1)::TIMESTAMP')}) / 60.0::DOUBLE AS heures, {month_hours('m')} AS heures_mois, {month_hours('m')} * 4 AS pas_mois, {utc('m::TIMESTAMP')} AS debut,
      {utc('(m + INTERVAL 1 MONTH)::TIMESTAMP')} AS fin, isodow(jour) AS jour_semaine FROM (SELECT DISTINCT o_orderdate::DATE AS jour, date_trunc('month', o_orderdate)::DATE AS m FROM orders)""",
    "p15_labels_codes": f"""SELECT c_custkey, {_normal.format("translate(n_name, 'AEIO', 'ÀÉÎÔ') || '-' || c_mktsegment")} AS libelle, {_department.format('code')} AS departement, CASE WHEN length(code) = 5 THEN coalesce({_city.format('code')}, code) ELSE code END AS commune,
      CASE WHEN c_custkey % 5 <> 0 THEN code ELSE coalesce({_city.format('rpad(code, 9, chr(48))')}, left(rpad(code, 9, '0'), 5)) END AS reconstituee, CASE c_custkey % 3 WHEN 0 THEN 'definitive' WHEN 1 THEN 'consolidee' ELSE 'temps_reel' END AS qualite, round(coalesce(c_acctbal, 0), 6) AS somme
      FROM (SELECT *, CASE c_custkey % 4 WHEN 0 THEN '97' || lpad((c_custkey % 1000)::VARCHAR, 3, '0') WHEN 1 THEN '751' || lpad((c_custkey % 20)::VARCHAR, 2, '0') ELSE lpad((c_custkey % 90000)::VARCHAR, 5, '0') END AS code FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "s2_paged_json": "SELECT json_extract_string(props, '$.k')::DOUBLE AS k, event_id // 10 AS page, row_number() OVER (PARTITION BY event_id // 10 ORDER BY event_id) - 1 AS pos FROM events",
    "s3_calendar": "SELECT jour_tempo::VARCHAR AS date_heure, CASE couleur WHEN 'bleu' THEN 'BLUE' WHEN 'blanc' THEN 'WHITE' ELSE 'RED' END AS couleur FROM tempo",
    "s4_geocoder": """SELECT id, CASE WHEN ok THEN CASE WHEN id % 11 = 3 THEN 0 ELSE (id % 10) / 10 END END AS score, CASE WHEN ok THEN t END AS precision, CASE WHEN ok THEN c END AS code_insee_commune, CASE WHEN ok THEN (id % 90)::DOUBLE END AS longitude,
      CASE WHEN ok THEN (id % 45)::DOUBLE END AS latitude, CASE WHEN ok AND id % 13 <> 4 THEN CASE WHEN id % 2 = 0 THEN 'Rhône' ELSE 'La Réunion' END END AS departement, CASE WHEN ok AND id % 13 <> 4 THEN CASE WHEN id % 2 = 0 THEN 'Auvergne-Rhône-Alpes' ELSE 'La Réunion' END END AS region,
      CASE WHEN ok AND id % 13 <> 4 THEN CASE WHEN id % 2 = 0 THEN '69' ELSE '974' END END AS code_departement, CASE WHEN ok THEN id % 11 = 3 OR (id % 10) / 10 < 0.4 END AS score_faible, CASE WHEN ok THEN id % 3 <> 0 END AS precision_grossiere,
      CASE WHEN ok AND id % 13 <> 4 THEN CASE WHEN id % 2 = 0 THEN '84' ELSE '04' END END AS code_insee_region, CASE WHEN NOT ok THEN 'introuvable' WHEN c IS NULL THEN 'sans_commune' WHEN id % 13 = 4 THEN 'contexte' END AS erreur
      FROM (SELECT c_custkey AS id, c_custkey % 10 <> 9 AS ok, CASE WHEN c_custkey % 17 <> 5 THEN lpad((c_nationkey + 1)::VARCHAR, 2, '0') || '001' END AS c, CASE c_custkey % 3 WHEN 0 THEN 'housenumber' WHEN 1 THEN 'municipality' END AS t FROM customer)""",
    "s9_window": "SELECT event_id, ts, round(value, 6) AS value FROM events WHERE ts >= TIMESTAMP '2024-01-17 12:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'",
    "s11_months": f"SELECT date_trunc('month', o_orderdate)::DATE AS mois, count(*) AS n FROM orders WHERE o_orderdate >= {utc('''TIMESTAMP '1997-06-01' ''')} AND o_orderdate < TIMESTAMP '1999-06-15' GROUP BY 1",
    "s13_days": "SELECT d::DATE AS jour, count(o_orderkey) AS n FROM generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '1997-12-31', INTERVAL 1 DAY) AS g(d) LEFT JOIN orders ON o_orderdate::DATE = d::DATE GROUP BY 1",
    "k2_upsert": "SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice, version::BIGINT AS version FROM (SELECT o_orderkey, o_custkey, o_totalprice, 0 AS version FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM latest) UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, version FROM latest)",
    "k3_upsert_metrics": "SELECT b AS rows_in_batch, l AS rows_merged, l - u AS rows_inserted, u AS rows_updated, b - l AS rows_deduplicated FROM (SELECT (SELECT count(*) FROM batch) AS b, (SELECT count(*) FROM latest) AS l, (SELECT count(*) FROM latest WHERE o_orderkey IN (SELECT o_orderkey FROM orders)) AS u)",
    "w3_ranks": f"SELECT c_nationkey::BIGINT AS c_nationkey, {r6('solde')}, CASE WHEN solde > 0 THEN rank() OVER (PARTITION BY solde > 0 ORDER BY solde DESC) END AS rang, count(*) FILTER (WHERE solde > 0) OVER () AS classes FROM (SELECT c_nationkey, sum(c_acctbal) - 60 * count(*) * max(c_acctbal) / 150 AS solde FROM customer GROUP BY 1)",
    "j7_bands": f"SELECT p_partkey AS site_id, {r6('p_retailprice / 40', 'puissance_mw')}, domaine_tension, gestionnaire FROM part LEFT JOIN seuils_raccordement ON p_retailprice / 40 >= puissance_min_mw AND (puissance_max_mw IS NULL OR p_retailprice / 40 < puissance_max_mw)",
    "q_checks": """SELECT c AS "check", s AS severity, v AS violations, CASE WHEN v = 0 THEN 'pass' ELSE s END AS verdict FROM (
      SELECT 'cle_absente' AS c, 'error' AS s, count(*) FILTER (WHERE l_orderkey IS NULL) AS v FROM lineitem UNION ALL SELECT 'etat_inconnu', 'warn', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem
      UNION ALL SELECT 'quantite', 'error', count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 40) FROM lineitem UNION ALL SELECT 'remise', 'warn', count(*) FILTER (WHERE l_discount > 0.05) FROM lineitem
      UNION ALL SELECT 'longueur', 'error', count(*) FILTER (WHERE length(l_linestatus) <> 1) FROM lineitem)""",
    "q1_duplicates": "SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "q4_orphans": "SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "q8_overlaps": "SELECT event_id, ts, minutes, suivant FROM (SELECT ts, min(event_id) AS event_id, max(user_id % 10)::BIGINT AS minutes, lead(ts) OVER (ORDER BY ts) AS suivant FROM events GROUP BY ts) WHERE suivant < ts + to_minutes(minutes)",
    "q9_hierarchy": f"SELECT annee, code_iris, {_department.format('code_insee_commune')} AS deduit, '00' AS publie FROM b_iris WHERE right(code_iris, 1) = '5' AND code_insee_commune IS NOT NULL",
    "q10_freshness": "SELECT max(date_heure) AS dernier, max(date_heure) FILTER (WHERE taux_co2 IS NOT NULL) AS dernier_mesure, count(*) AS nb_lignes, round(date_diff('second', max(date_heure) FILTER (WHERE taux_co2 IS NOT NULL), TIMESTAMP '2026-04-26 06:00:00') // 60 / 60.0, 6)::DOUBLE AS retard_heures, CASE WHEN date_diff('minute', max(date_heure) FILTER (WHERE taux_co2 IS NOT NULL), TIMESTAMP '2026-04-26 06:00:00') > 120 THEN 'en_retard' ELSE 'ok' END AS verdict FROM tr",
    "q11_month_coverage": f"""SELECT mois, n AS nb_instants, a AS nb_attendus, round(n / a, 6) AS couverture, CASE WHEN n / a >= 0.95 THEN 'ok' ELSE 'incomplet' END AS verdict FROM (
      SELECT m AS mois, (SELECT count(DISTINCT date_heure) FROM cons WHERE date_trunc('month', {paris('date_heure')})::DATE = m) AS n, {month_hours('m')} * 2 AS a FROM (
      SELECT CASE WHEN max(d) = DATE '2026-04-01' THEN (max(d) - INTERVAL 1 MONTH)::DATE ELSE max(d) END AS m FROM (SELECT date_trunc('month', {paris('date_heure')})::DATE AS d FROM cons)))""",
    "r1_incremental": "SELECT ts, event_id::VARCHAR AS event_id, event_type, round(CASE WHEN event_type = 'click' THEN value + 1 ELSE value END, 6) AS value FROM events",
    "m25_ingest": f"""SELECT charge::INT AS charge, CASE WHEN charge < 2 THEN n ELSE 0 END AS lignes, CASE WHEN charge = 0 THEN n ELSE 0 END AS inserees, CASE WHEN charge = 1 THEN n ELSE 0 END AS mises_a_jour, n AS en_base, montant,
      CASE WHEN charge < 2 THEN lues ELSE 0 END AS lues, CASE WHEN charge < 2 THEN sans_cle ELSE 0 END AS sans_cle, CASE WHEN charge < 2 THEN trou ELSE 0 END AS heure_inexistante, CASE WHEN charge < 2 THEN illisibles ELSE 0 END AS illisibles,
      CASE WHEN charge < 2 THEN dossiers ELSE 0 END AS dossiers FROM (VALUES (0), (1), (2)) AS c(charge),
      (SELECT count(*) FILTER (WHERE ok AND k % 19 <> 0) AS n, sum(CASE WHEN ok AND k % 19 <> 0 AND k % 13 <> 0 AND k % 17 <> 0 THEN round(o_totalprice, 2)::DECIMAL(18, 2) END)::DOUBLE AS montant, count(*) AS lues, count(*) FILTER (WHERE ok AND k % 19 = 0) AS sans_cle,
        count(*) FILTER (WHERE NOT ok) AS trou, count(*) FILTER (WHERE k % 13 = 0) AS illisibles, count(DISTINCT CASE WHEN ok AND k % 19 <> 0 THEN strftime(u, '%Y-%m') END) AS dossiers
        FROM (SELECT *, aware OR {paris(utc('t'))} = t AS ok, CASE WHEN aware THEN t ELSE {utc('t')} END AS u FROM rec))""",
    "s1_export": "SELECT c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS c_acctbal FROM customer",
    "s8_gold_table": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "k5_full_rebuild": " UNION ALL ".join(
        f"SELECT '{name}' AS produit, count(*) AS lignes, round(sum({FIGURES[name]})::DOUBLE, 3) AS somme FROM {cte}"
        for name, cte in {
            "mix_temps_reel": "tr", "mix_consolide": "cons", "mix_unifie": "mix", "jours_tempo": "tempo", "conso_industrielle": "areas", "equilibre_mensuel": "bal", "contraintes_reseau": "contr", "production": "prod", "mix": "fmix",
            "mix_journalier": "(SELECT jour, sum(consommation_mw * pas_minutes / 60.0::DOUBLE) / 1000 AS consommation_gwh FROM fmix GROUP BY jour)", "creneaux": "h", "cout_horaire": "ph", "cout_mensuel": "pm", "pression_commune": "communes",
            "pression_departement": "dep", "tension_region": "tens", "territoire": "terr",
        }.items()
    ),
    "r2_late_revision": f"SELECT heure_utc, heure_paris, jour, mois, heure_locale, jour_semaine, jour_tempo, couleur_tempo, periode_tarifaire, nb_mesures, est_complete, {_rounded('prix_ttc_eur_kwh taux_co2_g_kwh consommation_mw part_bas_carbone part_renouvelable')}, 2::BIGINT AS mois_refaits FROM h",
    "r3_reread": """SELECT mois, count(*) AS lignes, sum(round(p, 2)::DECIMAL(18, 2))::DOUBLE AS montant, mois >= '1996-05' AND mois <= '1998-04' AND mois <> '1997-11' AS inchange, mois = '1997-11' AS ecrit
      FROM (SELECT strftime(o_orderdate, '%Y-%m') AS mois, o_totalprice + CASE WHEN strftime(o_orderdate, '%Y-%m') = '1997-11' THEN 1 ELSE 0 END AS p FROM orders) GROUP BY mois""",
    "f4_month_report": f"""SELECT mois, {r6('avg(taux_co2_g_kwh)', 'co2_moyen')}, (min({{'r': taux_co2_g_kwh, 't': heure_utc}})).t AS heure_plus_propre, {r6('min(taux_co2_g_kwh)', 'co2_min')}, (min({{'r': -taux_co2_g_kwh, 't': heure_utc}})).t AS heure_plus_carbonee,
      {r6('max(taux_co2_g_kwh)', 'co2_max')}, {r6('quantile_cont(taux_co2_g_kwh, 0.9)', 'seuil_pic')} FROM h WHERE taux_co2_g_kwh IS NOT NULL AND mois = DATE '2026-04-01' GROUP BY mois""",
    "s6_seed_files": "SELECT code_departement, departement, region, est_zni, count(*) AS clients FROM customer JOIN dim_departement ON code_departement = lpad((c_nationkey + 1)::VARCHAR, 2, '0') JOIN dim_region USING (code_insee_region) GROUP BY ALL",
    "s12_guard": """SELECT jeu, refuse, CASE WHEN NOT refuse THEN lus END AS lus, CASE WHEN NOT refuse THEN charges END AS charges, premier, dernier FROM (VALUES ('orders_by_month', false), ('equilibre_regional_mensuel_prod_conso_brute', true)) AS v(jeu, refuse), (SELECT count(*) AS lus FROM orders),
      (SELECT count(*) AS charges, min(o_orderdate)::TIMESTAMP AS premier, max(o_orderdate)::TIMESTAMP AS dernier FROM orders WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1997-03-01')""",
    "k4_tables": "SELECT jeu, jeu <> 'national_tr' AS creee, CASE WHEN jeu = 'national_tr' THEN n ELSE 0 END AS lignes FROM (VALUES " + ", ".join(f"('{d.name}')" for d in DATASETS) + ") AS v(jeu), (SELECT count(*) AS n FROM tr)",
    "f9_latest_month": """SELECT mois AS cout_mois, 'Bureau tertiaire, 36 kVA' AS cout_profil_libelle, n::DOUBLE AS cout_conso_kwh, round(month(mois) / 12.0::DOUBLE, 6) AS cout_part_hc, x AS cout_cout_htva_eur, n::DOUBLE AS cout_prix_moyen_htva_eur_kwh, n::DOUBLE AS cout_intensite_moyenne_g_kwh,
      n::DOUBLE AS cout_kwh_decales, n::DOUBLE AS cout_gain_decalage_eur, n::DOUBLE AS cout_co2_evite_kg FROM (SELECT date_trunc('month', o_orderdate)::DATE AS mois, count(*) AS n, sum(round(o_totalprice, 2)::DECIMAL(18, 2))::DOUBLE AS x FROM orders GROUP BY 1)
      WHERE mois < DATE '1998-05-01' AND month(mois) % 4 NOT IN (0, 3) ORDER BY mois DESC LIMIT 1""",
    "j4_supplier_terms": """SELECT l_suppkey, count(*) AS lignes, count(remise) AS avec_conditions, sum((l_quantity * remise)::DECIMAL(18, 4))::DOUBLE AS remises FROM lineitem LEFT JOIN (
      SELECT s, debut, remise, lead(debut) OVER (PARTITION BY s ORDER BY debut) AS fin FROM (SELECT l_suppkey AS s, l_shipdate::DATE AS debut, max(l_discount) AS remise FROM lineitem WHERE l_linenumber = 1 GROUP BY ALL))
      ON s = l_suppkey AND l_shipdate::DATE >= debut AND (fin IS NULL OR l_shipdate::DATE < fin) GROUP BY l_suppkey""",
    "j7_price_bands": """SELECT tranche, count(*) AS commandes FROM orders LEFT JOIN (SELECT tranche, bas, lead(bas) OVER (PARTITION BY tranche // 100 ORDER BY bas) AS haut FROM (SELECT floor(p_retailprice)::BIGINT AS tranche, min(p_retailprice) AS bas FROM part GROUP BY 1))
      ON o_totalprice / 100 >= bas AND (haut IS NULL OR o_totalprice / 100 < haut) GROUP BY tranche""",
    "a17_quantiles": "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.9), 6) AS quantile FROM lineitem GROUP BY l_returnflag",
    "p10_sorted_files": "SELECT 'base' AS jeu, count(*) AS lignes, true AS en_ordre FROM orders UNION ALL SELECT 'inverse', count(*), false FROM orders",
    "p6_repeated_hour": f"""SELECT jour, i::INT AS i, CASE WHEN {paris('f')} = t THEN CASE WHEN i >= 6 AND {paris('(f + INTERVAL 1 HOUR)')} = t THEN f + INTERVAL 1 HOUR ELSE f END END AS instant, {paris('f')} <> t AS inexistante
      FROM (SELECT jour, i, t, CASE WHEN {paris("(" + utc('t') + " - INTERVAL 1 HOUR)")} = t THEN {utc('t')} - INTERVAL 1 HOUR ELSE {utc('t')} END AS f FROM (SELECT jour, i, jour::TIMESTAMP + to_minutes((CASE WHEN month(jour) = 3 THEN 60 + 15 * i WHEN i < 6 THEN 90 + 15 * i ELSE 30 + 15 * i END)::INT) AS t
      FROM (SELECT DISTINCT (last_day(o_orderdate::DATE) - (isodow(last_day(o_orderdate::DATE)) % 7)::INT)::DATE AS jour FROM orders WHERE month(o_orderdate) IN (3, 10)), generate_series(0, 9) AS g(i)))""",
}


def oracle_sql() -> dict[str, str]:
    """Every query with the expressions it needs, in order of definition."""
    out = {}
    for name, query in QUERY.items():
        needed, todo = set(), [query]
        while todo:
            text = todo.pop()
            for c in CTE:
                if c not in needed and re.search(rf"\b(?:FROM|JOIN|bal,)\s+{c}\b|\(SELECT [^()]* FROM {c}\)|, {c} WHERE", text):
                    needed.add(c)
                    todo.append(CTE[c])
        used = [f"{c} AS ({CTE[c]})" for c in CTE if c in needed]
        if name == "m10_daily_mix":
            query = query.replace(", 6) + 0", ", 8) + 0")
        out[name] = f"WITH {', '.join(used)} {query}" if used else query
    return out
