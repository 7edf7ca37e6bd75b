"""Industrial pressure, regional grid tension, and diagnoses of territories and sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.functions.text import balance_status, department_of, parent_commune
from gridmix.operators.ranges import by_size, range_join
from gridmix.operators.windows import rank_where

PROFILE = "bureau_36kva"
INDICATORS = ("pression_industrielle", "equilibre_regional", "contraintes_reseau", "seuil_raccordement", "capacite_raccordement", "cout_profil")


def reference_year(areas: DataFrame) -> DataFrame:
    """One row: the latest year without a masked value, or the latest year if all have some."""
    years = areas.groupBy("annee").agg(F.bool_or("est_secret").alias("_masked"))
    return years.agg(F.coalesce(F.max(F.when(~F.col("_masked"), F.col("annee"))), F.max("annee")).alias("annee"))


def commune_pressure(areas: DataFrame) -> DataFrame:
    year = F.broadcast(reference_year(areas))  # one row
    out = areas.join(year, "annee").groupBy("annee", "code_insee_commune").agg(
        F.min("commune").alias("commune"), F.min("code_departement").alias("code_departement"), F.min("code_insee_region").alias("code_insee_region"),
        F.coalesce(F.sum("consommation_electricite_mwh"), F.lit(0.0)).alias("consommation_electricite_mwh"), F.coalesce(F.sum("nb_sites_electricite"), F.lit(0)).cast("int").alias("nb_sites_electricite"),
        F.count(F.lit(1)).alias("nb_iris"), F.count(F.when(F.col("est_secret"), 1)).alias("nb_iris_secret"), F.bool_or("est_secret").alias("est_minorant"),
    )
    return out


def department_pressure(areas: DataFrame, departments: DataFrame) -> DataFrame:
    """Every department, those without data at zero, ranked among those that consume."""
    year = F.broadcast(reference_year(areas))  # one row
    own = areas.join(year, "annee").groupBy("code_departement").agg(
        F.sum("consommation_electricite_mwh").alias("_mwh"), F.sum("nb_sites_electricite").alias("_sites"), F.count_distinct(F.when(F.col("nb_sites_electricite") > 0, F.col("code_insee_commune"))).alias("_communes"),
        F.count(F.when(F.col("est_secret"), 1)).alias("_secret"),
    )
    zero = lambda c, t: F.coalesce(F.col(c), F.lit(0)).cast(t)
    full = departments.crossJoin(year).join(own, "code_departement", "left").select(
        "annee", "code_departement", "departement", "code_insee_region", zero("_mwh", "double").alias("consommation_electricite_mwh"), zero("_sites", "int").alias("nb_sites_electricite"),
        zero("_communes", "int").alias("nb_communes_avec_site"), zero("_secret", "int").alias("nb_iris_secret"),
    )
    full = full.withColumn("est_minorant", F.col("nb_iris_secret") > 0)
    ranked = full.withColumn("rang_national", rank_where("consommation_electricite_mwh", F.col("consommation_electricite_mwh") > 0))
    count = full.agg(F.count(F.when(F.col("consommation_electricite_mwh") > 0, 1)).alias("nb_departements_classes"))
    return ranked.crossJoin(F.broadcast(count))  # one row


def region_tension(balance: DataFrame, constraints: DataFrame, regions: DataFrame) -> DataFrame:
    """Every region: balance over the last twelve published months, constraints, status and rank of dependence."""
    bounds = F.broadcast(balance.agg(F.add_months(F.max("mois"), -11).alias("mois_debut"), F.max("mois").alias("mois_fin")))  # one row
    own = balance.crossJoin(bounds).where(F.col("mois").between(F.col("mois_debut"), F.col("mois_fin"))).groupBy("code_insee_region").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("production_totale_mwh").alias("_p"), F.sum("consommation_brute_mwh").alias("_c")
    )
    thousand = F.lit(1000.0)
    lost = F.col("energie_non_evacuee_printemps_mwh") + F.col("energie_non_evacuee_ete_mwh") + F.col("energie_non_evacuee_automne_mwh") + F.col("energie_non_evacuee_hiver_mwh")
    limits = constraints.select("code_insee_region", "puissance_enr_installee_mw", "puissance_a_compenser_mw", lost.alias("energie_non_evacuee_mwh"))
    rows = regions.crossJoin(bounds).join(own, "code_insee_region", "left").join(limits, "code_insee_region", "left").select(
        "code_insee_region", "region", "est_zni", "mois_debut", "mois_fin", F.coalesce("_n", F.lit(0)).cast("int").alias("nb_mois"), (F.col("_p") / thousand).alias("production_gwh"), (F.col("_c") / thousand).alias("consommation_gwh"),
        ((F.col("_p") - F.col("_c")) / thousand).alias("solde_gwh"), (F.col("_p") / F.nullif(F.col("_c"), F.lit(0.0))).alias("taux_couverture"), "puissance_enr_installee_mw", "puissance_a_compenser_mw", "energie_non_evacuee_mwh",
    )
    rows = rows.withColumn("statut_equilibre", balance_status(F.col("taux_couverture"))).withColumn("_need", -F.col("taux_couverture"))
    ranked = rows.withColumn("rang_dependance", rank_where("_need", F.col("taux_couverture").isNotNull())).drop("_need")
    return ranked.crossJoin(F.broadcast(rows.agg(F.count("taux_couverture").alias("nb_regions_classees"))))  # one row


def territory_diagnosis(pressure: DataFrame, tension: DataFrame) -> DataFrame:
    """Department pressure with its region's tension, consumption in GWh."""
    p = pressure.select(
        "code_departement", "departement", "code_insee_region", F.col("annee").alias("annee_pression"), (F.col("consommation_electricite_mwh") / F.lit(1000.0)).alias("conso_industrielle_departement_gwh"),
        F.col("nb_sites_electricite").alias("nb_sites_departement"), "nb_communes_avec_site", F.col("est_minorant").alias("conso_departement_est_minorant"), F.col("rang_national").alias("rang_pression_departement"), "nb_departements_classes",
    )
    t = tension.select(
        "code_insee_region", "region", "est_zni", F.col("mois_debut").alias("equilibre_mois_debut"), F.col("mois_fin").alias("equilibre_mois_fin"), F.col("nb_mois").alias("equilibre_nb_mois"),
        F.col("production_gwh").alias("production_region_gwh"), F.col("consommation_gwh").alias("consommation_region_gwh"), F.col("solde_gwh").alias("solde_region_gwh"), F.col("taux_couverture").alias("taux_couverture_region"),
        "statut_equilibre", F.col("rang_dependance").alias("rang_dependance_region"), "nb_regions_classees", "puissance_enr_installee_mw", "puissance_a_compenser_mw", "energie_non_evacuee_mwh",
    )
    return p.join(F.broadcast(t), "code_insee_region")  # 18 rows


def connection_band(sites: DataFrame, bands: DataFrame) -> DataFrame:
    """Adds the connection band of puissance_mw: half-open, the last one open; no power, no band; a negative one is an error."""
    power = F.when(F.col("puissance_mw") < 0, F.raise_error(F.lit("a negative power"))).otherwise(F.col("puissance_mw"))
    b = bands.select("domaine_tension", "gestionnaire", "commentaire", "puissance_min_mw", "puissance_max_mw")
    return range_join(sites.withColumn("puissance_mw", power), b, "puissance_mw", "puissance_min_mw", "puissance_max_mw", by_size)


def latest_priced_month(monthly: DataFrame, profiles: DataFrame, profile: str = PROFILE) -> DataFrame:
    """One row at most: the profile's latest complete month with a cost, with its label."""
    figures = ["mois", "conso_kwh", "part_hc", "cout_htva_eur", "prix_moyen_htva_eur_kwh", "intensite_moyenne_g_kwh", "kwh_decales", "gain_decalage_eur", "co2_evite_kg"]
    rows = monthly.where((F.col("profil") == profile) & F.col("est_complet") & F.col("cout_htva_eur").isNotNull())
    last = rows.groupBy("profil").agg(F.max_by(F.struct(*figures), "mois").alias("x")).select("profil", *(F.col(f"x.{c}").alias(c) for c in figures))
    labels = F.broadcast(profiles.select("profil", "libelle").dropDuplicates())
    return last.join(labels, "profil").select(F.col("mois").alias("cout_mois"), F.col("libelle").alias("cout_profil_libelle"), *(F.col(c).alias(f"cout_{c}") for c in figures[1:]))


def site_diagnosis(sites: DataFrame, territory: DataFrame, communes: DataFrame, bands: DataFrame, cost: DataFrame) -> DataFrame:
    """A whole table of sites (site_id, code_insee_commune, puissance_mw): department figures, those of the commune where
    it has any, the connection band and the cost of the default profile. Unknown departments are reported, not dropped."""
    own = sites.withColumn("code_commune", parent_commune(F.col("code_insee_commune")))
    own = own.withColumn("code_departement", department_of(F.col("code_commune")))
    c = communes.select(
        F.col("code_insee_commune").alias("code_commune"), "commune", (F.col("consommation_electricite_mwh") / F.lit(1000.0)).alias("conso_industrielle_commune_gwh"),
        F.col("nb_sites_electricite").alias("nb_sites_commune"), F.col("est_minorant").alias("conso_commune_est_minorant"),
    )
    found = own.join(F.broadcast(territory), "code_departement", "left").join(c, "code_commune", "left")
    found = found.withColumns({"departement_inconnu": F.col("departement").isNull(), "commune_a_des_sites": F.coalesce(F.col("nb_sites_commune") > 0, F.lit(False))})
    return connection_band(found, bands).join(F.broadcast(cost), F.lit(True), "left")  # one row


def site_limits(sites: DataFrame, limits: DataFrame) -> DataFrame:
    """(site, indicator, limit): each block of a diagnosis with what it doesn't say."""
    rows = sites.select("site_id", F.explode(F.array(*map(F.lit, INDICATORS))).alias("indicateur"))
    return rows.join(F.broadcast(limits.select("indicateur", "source", "maille", "millesime", "limite")), "indicateur")  # six rows
