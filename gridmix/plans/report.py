"""Monthly report sections over all months at once; each result has a column mois."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridmix.functions.instants import month_hours, month_of
from gridmix.operators.quantiles import exact_quantile
from gridmix.operators.windows import complete_windows, disjoint_best, islands, priced_where_known, sliding_windows

WINDOW_HOURS, KWH_PER_DAY, REFERENCE_HOUR, PEAK_QUANTILE = 3, 7.0, 18, 0.9
COLOURS = ("bleu", "blanc", "rouge")


def peak_threshold(slots: DataFrame, q: float = PEAK_QUANTILE, by_bins: bool = False) -> DataFrame:
    """Continuous quantile of a month's rates, exact; ``by_bins`` for far more rates a month than there are hours."""
    if by_bins:
        return exact_quantile(slots, "mois", "taux_co2_g_kwh", q).withColumnRenamed("quantile", "seuil_pic")
    return slots.groupBy("mois").agg(F.percentile("taux_co2_g_kwh", q).alias("seuil_pic"))


def carbon_summary(slots: DataFrame, q: float | None = PEAK_QUANTILE, by_bins: bool = False) -> DataFrame:
    """Mean, cleanest and dirtiest hour (the earliest of equal ones) and, unless q is None, peak threshold of each month."""
    if by_bins:
        return carbon_summary(slots, None).join(peak_threshold(slots, q, True), "mois")
    rate = F.col("taux_co2_g_kwh")
    measured = slots.where(rate.isNotNull())
    first_max = F.struct((-rate).alias("r"), F.col("heure_utc"))
    return measured.groupBy("mois").agg(
        F.avg(rate).alias("co2_moyen"), F.min(F.struct("taux_co2_g_kwh", "heure_utc")).alias("_min"), F.min(first_max).alias("_max"), *([F.percentile(rate, q).alias("seuil_pic")] if q is not None else []),
    ).select("mois", "co2_moyen", F.col("_min.heure_utc").alias("heure_plus_propre"), F.col("_min.taux_co2_g_kwh").alias("co2_min"), F.col("_max.heure_utc").alias("heure_plus_carbonee"), (-F.col("_max.r")).alias("co2_max"), *(["seuil_pic"] if q is not None else []))


def peak_hours(slots: DataFrame, q: float = PEAK_QUANTILE) -> DataFrame:
    """Slots with est_pic: strictly above the month's threshold."""
    return slots.join(F.broadcast(peak_threshold(slots, q)), "mois").withColumn("est_pic", F.coalesce(F.col("taux_co2_g_kwh") > F.col("seuil_pic"), F.lit(False)))  # a row per month


def peak_episodes(slots: DataFrame, q: float = PEAK_QUANTILE, k: int = 8) -> DataFrame:
    """Runs of consecutive peak hours: bounds, length, maximum, mean; the k worst of each month."""
    runs = islands(peak_hours(slots, q).where("est_pic"), "mois").groupBy("mois", "ilot").agg(
        F.min("heure_utc").alias("debut_utc"), (F.max("heure_utc") + F.make_dt_interval(hours=F.lit(1))).alias("fin_utc"), F.count(F.lit(1)).alias("nb_heures"),
        F.max("taux_co2_g_kwh").alias("co2_max"), F.avg("taux_co2_g_kwh").alias("co2_moyen"),
    )
    rank = F.row_number().over(W.partitionBy("mois").orderBy(F.col("co2_max").desc(), "debut_utc"))
    return runs.drop("ilot").withColumn("rang", rank.cast("long")).where(F.col("rang") <= k)


def worst_days(slots: DataFrame, tempo: DataFrame, k: int = 5) -> DataFrame:
    """The k days of highest mean rate of each month, with the day's colour (inconnue if there is none)."""
    days = slots.where(F.col("taux_co2_g_kwh").isNotNull()).groupBy("mois", "jour").agg(F.avg("taux_co2_g_kwh").alias("co2_moyen"))
    rank = F.row_number().over(W.partitionBy("mois").orderBy(F.col("co2_moyen").desc(), "jour"))
    top = days.withColumn("rang", rank.cast("long")).where(F.col("rang") <= k)
    colour = tempo.select(F.col("jour_tempo").alias("jour"), "couleur")
    return top.join(colour, "jour", "left").select("mois", "rang", "jour", "co2_moyen", F.coalesce("couleur", F.lit("inconnue")).alias("couleur"))


def tariff_summary(slots: DataFrame) -> DataFrame:
    """Hours, mean price and mean rate by colour and period, with ``ordre`` (blue, white, red; then hc, hp)."""
    out = slots.where(F.col("couleur_tempo").isNotNull()).groupBy("mois", "couleur_tempo", "periode_tarifaire").agg(F.count(F.lit(1)).alias("nb_heures"), F.avg("prix_ttc_eur_kwh").alias("prix_moyen"), F.avg("taux_co2_g_kwh").alias("co2_moyen"))
    place = F.array_position(F.array(*map(F.lit, COLOURS)), F.col("couleur_tempo")) * 2 + (F.col("periode_tarifaire") == "hp").cast("int")
    return out.withColumn("ordre", place.cast("long"))


def hour_profile(slots: DataFrame) -> DataFrame:
    return slots.groupBy("mois", "heure_locale").agg(F.avg("taux_co2_g_kwh").alias("co2_moyen"), F.avg("prix_ttc_eur_kwh").alias("prix_moyen"))


def colour_counts(tempo: DataFrame) -> DataFrame:
    """Days by colour and the red days of each month."""
    is_ = lambda c: F.count(F.when(F.col("couleur") == c, 1)).alias(f"jours_{c}")
    red = F.sort_array(F.collect_list(F.when(F.col("couleur") == "rouge", F.col("jour_tempo")))).alias("jours_rouges_liste")  # 31 at most
    return tempo.groupBy(month_of(F.col("jour_tempo")).alias("mois")).agg(*map(is_, COLOURS), red)


def candidate_windows(slots: DataFrame, n: int = WINDOW_HOURS) -> DataFrame:
    """Complete windows of n hours, fully priced where their month has prices; ``cle`` is the price if it counts."""
    found = priced_where_known(complete_windows(sliding_windows(slots, n), n), slots, n)
    return found.withColumn("cle", F.when(F.col("avec_prix"), F.col("prix_moyen")).otherwise(F.lit(0.0)))


WINDOW_COLUMNS = ["heure_utc", "heure_paris", "prix_moyen", "co2_moyen", "couleur_tempo", "periode_tarifaire"]


def _chosen(slots: DataFrame, n: int, k: int, order: list[Column]) -> DataFrame:
    return disjoint_best(candidate_windows(slots, n), "mois", order, k, F.col("heure_utc"), F.make_dt_interval(hours=F.lit(n)), WINDOW_COLUMNS)


def best_windows(slots: DataFrame, n: int = WINDOW_HOURS, k: int = 5) -> DataFrame:
    """The k best disjoint windows of each month, by price, rate and time. Overlap is judged in elapsed time (UTC)."""
    return _chosen(slots, n, k, [F.col("cle"), F.col("co2_moyen"), F.col("heure_utc")])


def worst_windows(slots: DataFrame, n: int = WINDOW_HOURS, k: int = 3) -> DataFrame:
    return _chosen(slots, n, k, [-F.col("cle"), -F.col("co2_moyen"), F.col("heure_utc")])


def flexible_saving(slots: DataFrame, kwh: float = KWH_PER_DAY, reference_hour: int = REFERENCE_HOUR, n: int = WINDOW_HOURS) -> DataFrame:
    """What a daily use of ``kwh`` saves in the day's best window against the window from the reference hour."""
    found = candidate_windows(slots, n)
    first = lambda rows, order: rows.withColumn("_rn", F.row_number().over(W.partitionBy("mois", "jour").orderBy(*order))).where("_rn = 1")
    best = first(found, ["cle", "co2_moyen", "heure_utc"]).select("mois", "jour", F.col("prix_moyen").alias("_p1"), F.col("co2_moyen").alias("_c1"))
    reference = first(found.where(F.col("heure_locale") == reference_hour), ["heure_utc"]).select("mois", "jour", F.col("prix_moyen").alias("_p2"), F.col("co2_moyen").alias("_c2"))
    use = F.lit(float(kwh))
    sums = best.join(reference, ["mois", "jour"]).groupBy("mois").agg(
        F.count(F.lit(1)).alias("nb_jours"), (F.sum("_p1") * use).alias("cout_optimise"), (F.sum("_p2") * use).alias("cout_reference"),
        (F.sum("_c1") * use / F.lit(1000.0)).alias("co2_optimise_kg"), (F.sum("_c2") * use / F.lit(1000.0)).alias("co2_reference_kg"),
    )
    return sums.withColumns({"gain_eur": F.col("cout_reference") - F.col("cout_optimise"), "gain_co2_kg": F.col("co2_reference_kg") - F.col("co2_optimise_kg")})


def coverage(slots: DataFrame, tempo: DataFrame, least: float = 0.98) -> DataFrame:
    """Header of each month: expected and complete hours, coloured days, prices, and notices."""
    hours = slots.groupBy("mois").agg(F.count(F.when(F.col("est_complete"), 1)).alias("heures_completes"), (F.count("prix_ttc_eur_kwh") > 0).alias("prix_disponibles"), (F.count("taux_co2_g_kwh") > 0).alias("a_des_donnees"))
    days = tempo.where(F.col("couleur").isNotNull()).groupBy(month_of(F.col("jour_tempo")).alias("mois")).agg(F.count(F.lit(1)).alias("_known"))
    out = hours.join(days, "mois", "left").select("mois", month_hours(F.col("mois")).alias("heures_attendues"), "heures_completes", F.day(F.last_day("mois")).cast("long").alias("jours_du_mois"), F.coalesce("_known", F.lit(0)).alias("jours_tempo_connus"), "prix_disponibles", "a_des_donnees")
    out = out.withColumn("couverture", F.when(F.col("heures_attendues") > 0, F.col("heures_completes") / F.col("heures_attendues")).otherwise(F.lit(0.0)))
    return out.withColumns({"avis_couverture": F.col("couverture") < least, "avis_couleurs": F.col("jours_tempo_connus") < F.col("jours_du_mois"), "avis_prix": ~F.col("prix_disponibles")})


def heat_map(slots: DataFrame) -> DataFrame:
    """Rate by day and local hour; a repeated hour keeps the larger value, an hour without data is null."""
    wide = slots.groupBy("mois", "jour").pivot("heure_locale", list(range(24))).agg(F.max("taux_co2_g_kwh"))
    return wide.select("mois", "jour", *(F.col(str(h)).alias(f"h{h:02d}") for h in range(24)))
