"""Silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridmix.functions.instants import paris_day
from gridmix.functions.text import department_of, month_date, normal_label, quality_of, quality_rank, rebuilt_commune, tempo_colour
from gridmix.specs import DETAIL_MEASURES, SEASONS, SHARED_MEASURES


def measured_series(bronze: DataFrame, minutes: int, details: bool = False) -> DataFrame:
    """Measured rows of one quality of the national series, with quality, rank and step."""
    measures = SHARED_MEASURES + (DETAIL_MEASURES if details else ())
    quality = quality_of(F.col("nature"))
    rows = bronze.where(F.col("consommation").isNotNull())
    return rows.select("date_heure", quality.alias("qualite"), quality_rank(quality).alias("rang_qualite"), F.lit(minutes).alias("pas_minutes"), *measures, "source_dataset", "ingested_at_utc")


def unified(consolidated: DataFrame, real_time: DataFrame, last: DataFrame | None = None) -> DataFrame:
    """All consolidated rows, and real-time rows from half an hour after the last of them (all, if there are none).

    The cut is by period: holes before it are never filled from the other quality. If only some months are given,
    ``last`` has the last consolidated instant of all.
    """
    columns = ["date_heure", "qualite", "rang_qualite", "pas_minutes", *SHARED_MEASURES, "source_dataset", "ingested_at_utc"]
    bound = (last or consolidated).agg((F.max("date_heure") + F.make_dt_interval(mins=F.lit(30))).alias("_from"))
    later = real_time.crossJoin(F.broadcast(bound)).where(F.col("_from").isNull() | (F.col("date_heure") >= F.col("_from")))  # one row
    return consolidated.select(*columns).unionByName(later.select(*columns))


def tempo_days(bronze: DataFrame) -> DataFrame:
    return bronze.where(F.col("couleur").isNotNull()).select(paris_day(F.col("date_heure")).alias("jour_tempo"), tempo_colour(F.col("couleur")).alias("couleur"))


def industrial_areas(bronze: DataFrame, departments: DataFrame) -> DataFrame:
    """Yearly consumption by small area: padded codes, rebuilt communes, one row per area and year."""
    code = F.lpad("code_iris", 9, "0")
    order = [F.length("code_iris").desc(), F.col("consommation_electricite_rte").desc_nulls_last()]
    first = bronze.withColumn("_rn", F.row_number().over(W.partitionBy("annee", code).orderBy(*order))).where("_rn = 1")
    rows = first.select(F.col("annee").cast("int").alias("annee"), code.alias("code_iris"), F.col("code_insee_commune").alias("_published"), "commune", "consommation_electricite_rte", "pdl_electricite_rte")
    rows = rows.withColumn("code_insee_commune", rebuilt_commune(F.col("_published"), F.col("code_iris")))
    rows = rows.withColumn("code_departement", department_of(F.col("code_insee_commune")))
    known = F.broadcast(departments.select("code_departement", "code_insee_region"))  # 101 rows
    return rows.join(known, "code_departement", "left").select(
        "annee", "code_iris", "code_insee_commune", "commune", F.col("_published").isNull().alias("est_commune_reconstituee"), "code_departement", "code_insee_region",
        F.col("consommation_electricite_rte").alias("consommation_electricite_mwh"), F.col("pdl_electricite_rte").alias("nb_sites_electricite"), F.col("consommation_electricite_rte").isNull().alias("est_secret"),
    )


def monthly_balance(bronze: DataFrame) -> DataFrame:
    mwh = {"production_totale": "production_totale_mwh", "consommation_brute": "consommation_brute_mwh", "pompage": "pompage_mwh", "solde_echanges_physiques": "solde_echanges_physiques_mwh"}
    return bronze.select(month_date(F.col("mois")).alias("mois"), "code_insee_region", *(F.col(a).alias(b) for a, b in mwh.items()))


def grid_constraints(bronze: DataFrame, regions: DataFrame) -> DataFrame:
    """Constraints by region code, joined on the normalised label; null where no region has it."""
    known = F.broadcast(regions.select(normal_label(F.col("region")).alias("_label"), "code_insee_region"))  # 18 rows
    rows = bronze.withColumn("_label", normal_label(F.col("region"))).join(known, "_label", "left")
    return rows.select(
        "code_insee_region", F.col("region").alias("libelle_publie"), F.col("puissance_enr_installee").alias("puissance_enr_installee_mw"), F.col("puissance_totale_a_compenser").alias("puissance_a_compenser_mw"),
        *(F.col(f"energie_non_evacuee_moyenne_{s}").alias(f"energie_non_evacuee_{s}_mwh") for s in SEASONS),
    )
