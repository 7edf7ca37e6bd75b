"""Gold tables of the national series and of load profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.functions.instants import day_hours, day_type, iso_weekday, month_hours, month_of, tariff_period, tempo_day, to_paris
from gridmix.functions.text import energy_mwh, weighted_mean
from gridmix.operators.ranges import by_month, by_value, range_join
from gridmix.specs import SOURCES



def production_by_source(mix: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per time and source with a value; pumping is not a source."""
    ids = ["date_heure", "qualite", "pas_minutes"]
    long = mix.select(*ids, *SOURCES).unpivot(ids, list(SOURCES), "filiere", "production_mw").where(F.col("production_mw").isNotNull())
    dim = F.broadcast(sources.select("filiere", "libelle", "famille", "est_renouvelable", "est_bas_carbone"))  # 8 rows
    local = to_paris(F.col("date_heure"))
    return long.join(dim, "filiere").select(
        "date_heure", local.alias("date_heure_paris"), F.to_date(local).alias("jour"), "qualite", "pas_minutes", "filiere", "libelle", "famille", "est_renouvelable", "est_bas_carbone",
        "production_mw", energy_mwh(F.col("production_mw"), F.col("pas_minutes")).alias("energie_mwh"),
    )


def mix_table(mix: DataFrame, production: DataFrame) -> DataFrame:
    """The mix at its measuring step with totals by family. Rows without any source stay, with totals of zero."""
    p = F.col("production_mw")
    families = production.groupBy("date_heure").agg(
        F.sum(p).alias("_all"), F.sum(F.when(F.col("est_bas_carbone"), p)).alias("_low"),
        F.sum(F.when(F.col("est_renouvelable"), p)).alias("_renewable"), F.sum(F.when(F.col("famille") == "fossile", p)).alias("_fossil"),
    )
    total = F.nullif(F.col("_all"), F.lit(0.0))
    local = to_paris(F.col("date_heure"))
    zero = F.lit(0.0)
    return mix.join(families, "date_heure", "left").select(
        "date_heure", local.alias("date_heure_paris"), F.to_date(local).alias("jour"), "qualite", "rang_qualite", "pas_minutes",
        F.col("consommation").alias("consommation_mw"), F.col("prevision_j1").alias("prevision_j1_mw"), F.col("prevision_j").alias("prevision_j_mw"),
        (F.col("consommation") - F.col("prevision_j1")).alias("ecart_prevision_j1_mw"), *(F.col(s).alias(f"{s}_mw") for s in SOURCES), F.col("pompage").alias("pompage_mw"),
        F.coalesce("_all", zero).alias("production_totale_mw"), F.coalesce("_low", zero).alias("production_bas_carbone_mw"), F.coalesce("_renewable", zero).alias("production_renouvelable_mw"),
        F.coalesce("_fossil", zero).alias("production_fossile_mw"), (F.col("_low") / total).alias("part_bas_carbone"), (F.col("_renewable") / total).alias("part_renouvelable"),
        F.col("ech_physiques").alias("solde_echanges_mw"), F.col("taux_co2").alias("taux_co2_g_kwh"),
    )


def daily_mix(mix: DataFrame) -> DataFrame:
    """Energy balance by civil day in Paris; energies are sums of power times duration."""
    h = F.col("pas_minutes") / F.lit(60.0)
    total, rate, used = F.col("production_totale_mw"), F.col("taux_co2_g_kwh"), F.col("consommation_mw")
    gwh = lambda c: F.sum(c * h) / F.lit(1000.0)
    share = lambda c: F.sum(F.col(c) * h) / F.nullif(F.sum(total * h), F.lit(0.0))
    days = mix.groupBy("jour").agg(
        F.min_by("qualite", F.struct("rang_qualite", "qualite")).alias("qualite"), F.count(F.lit(1)).alias("nb_mesures"), F.sum(h).alias("heures_couvertes"), gwh(used).alias("consommation_gwh"),
        F.max(used).alias("pointe_consommation_mw"), F.min(used).alias("creux_consommation_mw"), gwh(total).alias("production_gwh"),
        *(gwh(F.coalesce(F.col(f"{s}_mw"), F.lit(0.0))).alias(f"{s}_gwh") for s in SOURCES), share("production_bas_carbone_mw").alias("part_bas_carbone"),
        share("production_renouvelable_mw").alias("part_renouvelable"), gwh(F.col("solde_echanges_mw")).alias("solde_echanges_gwh"), gwh(rate * total).alias("emissions_tco2"),
        weighted_mean(rate, total * h).alias("taux_co2_moyen_g_kwh"),
    )
    first = ["jour", "qualite", "nb_mesures", "heures_couvertes", "heures_du_jour", "est_complet"]
    out = days.withColumn("heures_du_jour", day_hours(F.col("jour")))
    out = out.withColumn("est_complet", F.col("heures_couvertes") >= F.col("heures_du_jour"))
    return out.select(*first, *(c for c in days.columns if c not in first))


def hourly_slots(mix: DataFrame, tempo: DataFrame, grid: DataFrame) -> DataFrame:
    """Hour by hour: carbon rate, colour, tariff period, price (null where unknown). The key is the hour in UTC."""
    rate, total = F.col("taux_co2_g_kwh"), F.col("production_totale_mw")
    hours = mix.groupBy(F.date_trunc("HOUR", "date_heure").alias("heure_utc")).agg(
        F.count(F.lit(1)).alias("nb_mesures"), F.sum("pas_minutes").alias("_minutes"), F.avg("consommation_mw").alias("consommation_mw"),
        weighted_mean(rate, total).alias("taux_co2_g_kwh"), F.avg("part_bas_carbone").alias("part_bas_carbone"), F.avg("part_renouvelable").alias("part_renouvelable"),
    )
    local = hours.withColumn("heure_paris", to_paris(F.col("heure_utc")))
    local = local.withColumns({"jour": F.to_date("heure_paris"), "heure_locale": F.hour("heure_paris")})
    local = local.withColumns({"periode_tarifaire": tariff_period(F.col("heure_locale")), "jour_tempo": tempo_day(F.col("jour"), F.col("heure_locale"))})
    coloured = local.join(tempo.select("jour_tempo", F.col("couleur").alias("couleur_tempo")), "jour_tempo", "left")
    priced = range_join(coloured, grid, "jour", "date_debut", "date_fin", by_month, {"couleur_tempo": "couleur", "periode_tarifaire": "periode"})
    return priced.select(
        "heure_utc", "heure_paris", "jour", month_of(F.col("jour")).alias("mois"), "heure_locale", iso_weekday(F.col("jour")).alias("jour_semaine"), "jour_tempo", "couleur_tempo",
        "periode_tarifaire", "prix_ttc_eur_kwh", "taux_co2_g_kwh", "consommation_mw", "part_bas_carbone", "part_renouvelable", "nb_mesures", (F.col("_minutes") >= 60).alias("est_complete"),
    )


def hourly_profile_cost(slots: DataFrame, profiles: DataFrame, grid: DataFrame) -> DataFrame:
    """Energy, cost and emissions of each load profile in each hour; hours outside all bands of a profile vanish."""
    typed = slots.withColumn("type_jour", day_type(F.col("jour_semaine")))
    hours = typed.select("heure_utc", "jour", "mois", "heure_locale", "type_jour", "periode_tarifaire", "taux_co2_g_kwh", "est_complete")
    hours = range_join(hours, profiles, "heure_locale", "heure_debut", "heure_fin", by_value, {"type_jour": "type_jour"}, "inner")
    priced = range_join(hours, grid, "jour", "date_debut", "date_fin", by_month, {"periode_tarifaire": "periode"})
    price, kw = F.col("prix_ht_eur_kwh") + F.col("accise_eur_kwh"), F.col("puissance_kw")
    return priced.select(
        "profil", "heure_utc", "jour", "mois", "heure_locale", "type_jour", "periode_tarifaire", "est_complete", kw.alias("conso_kwh"), F.col("puissance_flexible_kw").alias("conso_flexible_kwh"),
        price.alias("prix_htva_eur_kwh"), (kw * price).alias("cout_htva_eur"), "taux_co2_g_kwh", (kw * F.col("taux_co2_g_kwh") / F.lit(1000.0)).alias("emissions_kgco2"),
    )


def monthly_profile_cost(hourly: DataFrame) -> DataFrame:
    """Monthly energy, cost, emissions, and what moving the flexible load into the same day's off-peak hours gains."""
    peak, off = F.col("periode_tarifaire") == "hp", F.col("periode_tarifaire") == "hc"
    flexible, price, rate = F.col("conso_flexible_kwh"), F.col("prix_htva_eur_kwh"), F.col("taux_co2_g_kwh")
    days = hourly.groupBy("profil", "mois", "jour").agg(
        F.sum(F.when(peak, flexible)).alias("moved"), F.sum(F.when(peak, flexible * price)).alias("cost"), (F.sum(F.when(peak, flexible * rate)) / F.lit(1000.0)).alias("emitted"),
        F.max(F.when(off, price)).alias("off_price"), F.avg(F.when(off, rate)).alias("off_rate"),
    )
    gains = days.groupBy("profil", "mois").agg(
        F.sum("moved").alias("kwh_decales"), F.sum(F.col("cost") - F.col("moved") * F.col("off_price")).alias("_gain"), F.sum(F.col("emitted") - F.col("moved") * F.col("off_rate") / F.lit(1000.0)).alias("co2_evite_kg"),
    )
    kwh = F.col("conso_kwh")
    months = hourly.groupBy("profil", "mois").agg(
        F.count(F.lit(1)).alias("nb_heures"), F.every("est_complete").alias("_whole"), F.sum(kwh).alias("conso_kwh"), F.sum(F.when(off, kwh)).alias("_off"),
        (F.count("prix_htva_eur_kwh") == F.count(F.lit(1))).alias("_priced"), F.sum("cout_htva_eur").alias("_cost"), F.sum("emissions_kgco2").alias("emissions_kgco2"),
    )
    expected = month_hours(F.col("mois"))
    per_kwh = F.nullif(F.col("conso_kwh"), F.lit(0.0))
    return months.join(gains, ["profil", "mois"]).select(
        "profil", "mois", "nb_heures", expected.alias("nb_heures_attendues"), (F.col("_whole") & (F.col("nb_heures") == expected)).alias("est_complet"), "conso_kwh", (F.col("_off") / per_kwh).alias("part_hc"),
        F.when(F.col("_priced"), F.col("_cost")).alias("cout_htva_eur"), F.when(F.col("_priced"), F.col("_cost") / per_kwh).alias("prix_moyen_htva_eur_kwh"), "emissions_kgco2",
        (F.col("emissions_kgco2") * 1000 / per_kwh).alias("intensite_moyenne_g_kwh"), "kwh_decales", F.when(F.col("_priced"), F.col("_gain")).alias("gain_decalage_eur"), "co2_evite_kg",
    )
