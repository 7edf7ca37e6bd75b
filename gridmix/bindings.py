"""Queries that run the library on the driver's tables. Energy tables don't exist there, so series, areas and balances
are derived from events, orders, customers and suppliers; ``bindings_sql`` has the same in SQL."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix.functions import instants, text
from gridmix.operators import quality, quantiles, ranges, upsert, windows
from gridmix.operators.conform import conform
from gridmix.plans import gold, rebuild, report, silver, territory
from gridmix.sources import payloads, tables
from gridmix.sources.seeds import read_seed, seed
from gridmix.specs import BALANCE, CONSTRAINTS, DATASETS, DETAIL_MEASURES, IRIS, NATIONAL_CONS_DEF, NATIONAL_TR, SEASONS, SHARED_MEASURES, SOURCES, TEMPO, Dataset, by_month
from gridmix.streaming.incremental import load_landed

#: Events are moved by so many days, to a spring with a change of the clock and published tariffs.
SHIFT_DAYS = 816
CONSOLIDATED_END, REAL_TIME_START, DEFINITIVE_END = dt.datetime(2026, 4, 16), dt.datetime(2026, 4, 10), dt.datetime(2026, 4, 5)
REGION_CODES = ("84", "27", "53", "24", "94", "44", "32", "11", "28", "75", "76", "52")
LOADED = dt.datetime(2026, 7, 1, 3, tzinfo=dt.timezone.utc)


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded (sums of doubles depend on their order), integers as long, instants as UTC wall-clock times."""

    def one(f: T.StructField):
        c = F.col(f"`{f.name}`")
        match f.dataType:
            case T.DoubleType() | T.FloatType() | T.DecimalType():
                return (F.round(c.cast("double"), digits) + F.lit(0.0)).alias(f.name)  # no negative zero
            case T.IntegerType() | T.ShortType():
                return c.cast("long").alias(f.name)
            case T.TimestampType():
                return c.cast("timestamp_ntz").alias(f.name)
        return c

    return df.select(*map(one, df.schema.fields))


# --- derived bronze tables ---------------------------------------------------------------------------------------


def slots(spark: SparkSession, d: str, minutes: int) -> DataFrame:
    """Events gathered in slots of some minutes, with the measures of the national series."""
    e = read(spark, d, "events").withColumn("ts", (F.col("ts") + F.make_dt_interval(days=F.lit(SHIFT_DAYS))).cast("timestamp"))
    e = e.withColumn("date_heure", F.timestamp_seconds(F.floor(F.unix_timestamp("ts") / F.lit(60 * minutes)) * F.lit(60 * minutes)))
    own = lambda k: F.sum(F.when(F.col("user_id") % 8 == k, F.col("value")))
    n = F.count(F.lit(1))
    return e.groupBy("date_heure").agg(
        F.sum("value").alias("consommation"), (F.avg("value") * 3).alias("prevision_j1"), (F.max("value") * 2).alias("prevision_j"), *(own(k).alias(s) for k, s in enumerate(SOURCES)),
        (-F.min("value")).alias("pompage"), (F.max("value") - F.sum("value")).alias("ech_physiques"), F.when(n % 11 != 0, F.avg(F.col("user_id") % 97)).alias("taux_co2"),
    )


def bronze_series(spark: SparkSession, d: str, spec: Dataset, minutes: int) -> DataFrame:
    real_time = spec is NATIONAL_TR
    rows = slots(spark, d, minutes)
    at = F.col("date_heure").cast("timestamp_ntz")
    rows = rows.where(at >= F.lit(REAL_TIME_START)) if real_time else rows.where(at < F.lit(CONSOLIDATED_END))
    nature = F.lit("Données temps réel") if real_time else F.when(at < F.lit(DEFINITIVE_END), "Données définitives").otherwise("Données consolidées")
    rows = rows.withColumns({"nature": nature, "perimetre": F.lit("France"), "ingested_at_utc": F.lit(LOADED), "source_dataset": F.lit(spec.name)})
    return rows.select(*(F.col(c) if c in rows.columns else F.lit(None).cast(t.dataType).alias(c) for c, t in zip(spec.stored.fieldNames(), spec.stored)))


def real_time(spark, d):
    return silver.measured_series(bronze_series(spark, d, NATIONAL_TR, 15), 15)


def consolidated(spark, d):
    return silver.measured_series(bronze_series(spark, d, NATIONAL_CONS_DEF, 30), 30, details=True)


def mix(spark, d):
    return silver.unified(consolidated(spark, d), real_time(spark, d))


def bronze_tempo(spark, d):
    days = read(spark, d, "events").select(F.to_date(F.col("ts") + F.make_dt_interval(days=F.lit(SHIFT_DAYS))).alias("j")).distinct()
    k = F.dayofyear("j") % 7
    colour = F.when(k == 0, F.lit(None)).when(k <= 4, "BLUE").when(k == 5, "WHITE").otherwise("RED")
    return days.select(instants.from_paris(F.col("j")).alias("date_heure"), colour.alias("couleur"))


def tempo(spark, d):
    return silver.tempo_days(bronze_tempo(spark, d))


def production(spark, d):
    return gold.production_by_source(mix(spark, d), seed(spark, "dim_filiere"))


def fct_mix(spark, d):
    """The two series that feed everything else; in a pipeline both are stored tables."""
    m = mix(spark, d)
    return gold.mix_table(m, gold.production_by_source(m, seed(spark, "dim_filiere")))


def hourly(spark, d):
    return gold.hourly_slots(fct_mix(spark, d), tempo(spark, d), seed(spark, "tarifs_tempo"))


def profile_hours(spark, d):
    return gold.hourly_profile_cost(hourly(spark, d), seed(spark, "profils_consommation"), seed(spark, "tarifs_hphc"))


def profile_months(spark, d):
    return gold.monthly_profile_cost(profile_hours(spark, d))


def bronze_areas(spark, d):
    """Small areas from customers: codes of departments 01 to 25, some without their leading zero and without commune."""
    c = read(spark, d, "customer").where(F.col("c_nationkey") != 19)
    commune = F.concat(F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"), F.lpad((F.col("c_custkey") % 60).cast("string"), 3, "0"))
    lost = (F.col("c_custkey") % 10 == 0) & (F.col("c_nationkey") < 9)
    iris = F.concat(commune, F.lpad((F.col("c_custkey") % 40).cast("string"), 4, "0"))
    rows = c.groupBy((2020 + F.col("c_custkey") % 3).cast("string").alias("annee"), F.when(lost, F.substring(iris, 2, 8)).otherwise(iris).alias("code_iris"), F.when(~lost, commune).alias("code_insee_commune")).agg(
        F.max(F.when(~lost, F.concat(F.lit("C"), commune))).alias("commune"), F.sum(F.when((F.col("c_acctbal") >= 0) | (F.col("c_custkey") % 3 < 2), F.abs("c_acctbal"))).alias("consommation_electricite_rte"),
        F.sum(F.col("c_custkey") % 4).cast("double").alias("pdl_electricite_rte"),
    )
    return rows


def areas(spark, d):
    return silver.industrial_areas(bronze_areas(spark, d), seed(spark, "dim_departement"))


def bronze_balance(spark, d):
    region = F.get(F.array(*map(F.lit, REGION_CODES)), (F.col("o_custkey") % 13).cast("int"))  # the thirteenth has none
    o = read(spark, d, "orders").withColumn("code_insee_region", region).where("code_insee_region is not null")
    price = F.col("o_totalprice")
    return o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("mois"), "code_insee_region").agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", price * 2)).alias("production_totale"), F.sum(price).alias("consommation_brute"), F.min(price).alias("pompage"), F.max(price).alias("solde_echanges_physiques"),
    )


def bronze_constraints(spark, d):
    """Constraints by upper-case label from suppliers; one label is unknown."""
    r = seed(spark, "dim_region").where(F.col("code_insee_region").isin(*REGION_CODES[:8])).select(F.upper("region").alias("region"), F.array_position(F.array(*map(F.lit, REGION_CODES)), F.col("code_insee_region")).alias("k"))
    r = r.unionByName(spark.createDataFrame([("ATLANTIDE", 9)], "region string, k long"))
    s = read(spark, d, "supplier").groupBy((F.col("s_suppkey") % 9 + 1).alias("k")).agg(F.sum("s_acctbal").alias("a"), F.max("s_acctbal").alias("b"))
    return s.join(F.broadcast(r), "k").select("region", F.col("a").alias("puissance_enr_installee"), F.col("b").alias("puissance_totale_a_compenser"), *((F.col("b") + i).alias(f"energie_non_evacuee_moyenne_{x}") for i, x in enumerate(SEASONS)))


def tension(spark, d):
    regions = seed(spark, "dim_region")
    return territory.region_tension(silver.monthly_balance(bronze_balance(spark, d)), silver.grid_constraints(bronze_constraints(spark, d), regions), regions)


def pressure(spark, d):
    return territory.department_pressure(areas(spark, d), seed(spark, "dim_departement"))


def sites(spark, d):
    s = read(spark, d, "supplier")
    code = F.when(F.col("s_suppkey") % 7 == 0, "75101").when(F.col("s_suppkey") % 7 == 1, "99001").otherwise(F.concat(F.lpad((F.col("s_nationkey") + 1).cast("string"), 2, "0"), F.lpad((F.col("s_suppkey") % 60).cast("string"), 3, "0")))
    return s.select(F.col("s_suppkey").alias("site_id"), code.alias("code_insee_commune"), F.when(F.col("s_suppkey") % 5 != 0, F.abs("s_acctbal") / 200).alias("puissance_mw"))


def diagnosis(spark, d):
    a = areas(spark, d)
    return territory.site_diagnosis(
        sites(spark, d), territory.territory_diagnosis(territory.department_pressure(a, seed(spark, "dim_departement")), tension(spark, d)), territory.commune_pressure(a),
        seed(spark, "seuils_raccordement"), territory.latest_priced_month(gold.monthly_profile_cost(profile_hours(spark, d)).withColumn("est_complet", F.lit(True)), seed(spark, "profils_consommation")),
    )


# --- operators on the tables as they are -------------------------------------------------------------------------

ORDERS = Dataset("orders_text", ("o_orderdate", "o_orderkey"), ("o_orderpriority", "absent"), ("o_totalprice", "o_clerk_score"), "o_orderdate", by_month("o_orderdate"))


def order_records(spark, d):
    """Orders as text records: a local date and time, some prices unreadable, some blank keys."""
    o = read(spark, d, "orders")
    k = F.col("o_orderkey")
    when = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T"), F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":30:00"), F.when(k % 2 == 0, "Z").otherwise(""))
    price = F.when(k % 13 == 0, "n/a").when(k % 17 == 0, " ").otherwise(F.concat(F.lit(" "), F.format_string("%.2f", "o_totalprice")))
    return o.select(when.alias("o_orderdate"), F.when(k % 19 != 0, k.cast("string")).otherwise("  ").alias("o_orderkey"), F.concat(F.col("o_orderpriority"), F.lit(" ")).alias("o_orderpriority"), price.alias("o_totalprice"), F.lit(True).alias("o_clerk_score"), k.alias("_seq"))


def conformed(spark, d):
    return conform(order_records(spark, d), ORDERS, LOADED).rows.drop("_seq")


def conform_rejects(spark, d):
    c = conform(order_records(spark, d), ORDERS, LOADED)
    raw = order_records(spark, d).where(text.is_unreadable(F.col("o_totalprice"))).select("_seq", F.lit("illisible").alias("motif"))
    return raw.unionByName(c.without_key.select("_seq", F.lit("sans_cle").alias("motif"))).unionByName(c.in_gap.select("_seq", F.lit("heure_inexistante").alias("motif"))).withColumnRenamed("_seq", "seq")


def order_batch(spark, d):
    """A batch of revisions: all orders that aren't finished, some twice, and new ones."""
    o = read(spark, d, "orders").where("o_orderstatus <> 'F'").select("o_orderkey", "o_custkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.lit(1).alias("version"), F.col("o_orderkey").alias("_seq"))
    again = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.lit(None).cast("long").alias("o_custkey"), (F.col("o_totalprice") + 1).alias("o_totalprice"), F.when(F.col("o_orderkey") % 4 == 0, 2).otherwise(1).alias("version"), (F.col("_seq") + 1).alias("_seq"))
    new = o.where("o_orderkey % 5 = 0").withColumn("o_orderkey", -F.col("o_orderkey"))
    return o.unionByName(again).unionByName(new)


def upserted(spark, d):
    batch = upsert.latest(order_batch(spark, d), ["o_orderkey"], ["o_custkey", "o_totalprice"], "version").drop("_seq")
    target = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.lit(0).alias("version"))
    return upsert.merged(target, batch, ["o_orderkey"])


def upsert_counts(spark, d):
    batch = order_batch(spark, d)
    return upsert.upsert_metrics(read(spark, d, "orders"), batch, upsert.latest(batch, ["o_orderkey"], ["o_custkey", "o_totalprice"], "version"), ["o_orderkey"])


def props_json(spark, d):
    """A paged payload: the props of ten events are a page's results."""
    e = read(spark, d, "events")
    pages = e.groupBy(F.floor(F.col("event_id") / 10).alias("page")).agg(F.sort_array(F.collect_list(F.struct("event_id", "props"))).alias("r"))
    pages = pages.select("page", F.concat(F.lit('{"results":['), F.array_join(F.transform("r", lambda x: F.coalesce(x["props"], F.lit("{}"))), ","), F.lit("]}")).alias("value"))
    spec = Dataset("props", ("k",))
    return payloads.records_of_pages(pages, spec).select(text.to_measure(F.col("k")).alias("k"), F.col("_seq.page").cast("long").alias("page"), F.col("_seq.pos").cast("long").alias("pos"))


def calendar_scan(spark, d):
    days = bronze_tempo(spark, d).select(F.date_format(instants.to_paris(F.col("date_heure")), "yyyy-MM-dd").alias("start_date"), F.coalesce("couleur", F.lit("NOT_AVAILABLE")).alias("value"))
    months = days.groupBy(F.left("start_date", F.lit(7)).alias("m")).agg(F.sort_array(F.collect_list(F.struct("start_date", "value")), asc=False).alias("values"))
    return payloads.calendar_days(months.select(F.to_json(F.struct(F.struct("values").alias("tempo_like_calendars"))).alias("value")))


def geocoder_scan(spark, d):
    """One stored geocoder response per customer; some without a feature, commune code, context, score or precision."""
    c = read(spark, d, "customer")
    k = F.col("c_custkey")
    p = F.struct(
        F.col("c_name").alias("label"), F.when(k % 11 != 3, (k % 10) / 10).alias("score"), F.when(k % 3 == 0, "housenumber").when(k % 3 == 1, "municipality").alias("type"),
        F.when(k % 17 != 5, F.concat(F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"), F.lit("001"))).alias("citycode"), F.lit("Ville").alias("city"), F.lit("00000").alias("postcode"),
        F.when(k % 13 == 4, "Rhône").when(k % 2 == 0, "69, Rhône, Auvergne-Rhône-Alpes").otherwise("974, La Réunion").alias("context"),
    )
    f = F.struct(F.struct(F.array((k % 90).cast("double"), (k % 45).cast("double")).alias("coordinates")).alias("geometry"), p.alias("properties"))
    body = F.to_json(F.struct(F.filter(F.array(f), lambda _: k % 10 != 9).alias("features")))
    out = payloads.geocoded(c.select(F.col("c_custkey").alias("id"), body.alias("value")), seed(spark, "dim_region"))
    return out.select("id", "score", "precision", "code_insee_commune", "longitude", "latitude", "departement", "region", "code_departement", "score_faible", "precision_grossiere", "code_insee_region", "erreur")


def labels_and_codes(spark, d):
    """Text functions on nations and customers."""
    c = read(spark, d, "customer").join(F.broadcast(read(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    accented = F.translate(F.col("n_name"), "AEIO", "ÀÉÎÔ")
    code = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("97"), F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"))).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("751"), F.lpad((F.col("c_custkey") % 20).cast("string"), 2, "0"))).otherwise(F.lpad((F.col("c_custkey") % 90000).cast("string"), 5, "0"))
    return c.select(
        "c_custkey", text.normal_label(F.concat(accented, F.lit("-"), F.col("c_mktsegment"))).alias("libelle"), text.department_of(code).alias("departement"), text.parent_commune(code).alias("commune"),
        text.rebuilt_commune(F.when(F.col("c_custkey") % 5 != 0, code), F.rpad(code, 9, "0")).alias("reconstituee"), text.quality_of(F.when(F.col("c_custkey") % 3 == 0, "Données DÉFINITIVES").when(F.col("c_custkey") % 3 == 1, "consolidée").otherwise("temps réel")).alias("qualite"),
        text.sum_of(["c_acctbal"]).alias("somme"),
    )


def repeated_hour(spark, d):
    """Order times as local texts on the nights the clock changes: instants, or the mark of an hour that doesn't exist."""
    o = read(spark, d, "orders").where("month(o_orderdate) in (3, 10)")
    last_sunday = F.date_sub(F.last_day("o_orderdate"), F.weekday(F.date_add(F.last_day("o_orderdate"), 1)).cast("int"))
    rows = o.groupBy(last_sunday.alias("jour")).agg(F.min("o_orderkey").alias("k"))
    steps = rows.select("jour", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("i"))
    minute = F.when(F.month("jour") == 10, F.when(F.col("i") < 6, 90 + 15 * F.col("i")).otherwise(120 + 15 * (F.col("i") - 6))).otherwise(60 + 15 * F.col("i"))
    local = F.concat(F.date_format("jour", "yyyy-MM-dd"), F.lit("T"), F.lpad(F.floor(minute / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((minute % 60).cast("string"), 2, "0"))
    texts = steps.select("jour", F.col("i").alias("_seq"), local.alias("t"), F.date_format("jour", "yyyy").alias("serie"))
    return instants.resolve_instants(texts, "t", ["serie"]).select("jour", F.col("_seq").alias("i"), F.when(~F.col("_gap"), F.col("t")).alias("instant"), F.col("_gap").alias("inexistante"))


def civil_calendar(spark, d):
    """Hours of each order's day and month in Paris, and the month's bounds in UTC."""
    days = read(spark, d, "orders").select(F.to_date("o_orderdate").alias("jour")).distinct()
    j = F.col("jour")
    return days.select("jour", instants.day_hours(j).alias("heures"), instants.month_hours(j).alias("heures_mois"), instants.month_slots(j, 15).alias("pas_mois"), instants.month_start(j).alias("debut"), instants.month_end(j).alias("fin"), instants.iso_weekday(j).alias("jour_semaine"))


def recent_events(spark, d):
    """Half-open window of the last three hours before a moment, pushed to the scan."""
    now = dt.datetime(2024, 1, 20, 12, tzinfo=dt.timezone.utc)
    w = instants.TimeWindow.last_hours(72, now)
    e = read(spark, d, "events")
    naive = lambda t: F.lit(t.replace(tzinfo=None))
    return e.where((F.col("ts") >= naive(w.start)) & (F.col("ts") < naive(w.end))).select("event_id", "ts", "value")


def month_windows(spark, d):
    w = instants.TimeWindow.last_months(24, dt.datetime(1999, 6, 15, tzinfo=dt.timezone.utc))
    o = read(spark, d, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp"))
    return o.where(w.holds("at")).groupBy(instants.month_of(F.to_date("o_orderdate")).alias("mois")).agg(F.count(F.lit(1)).alias("n"))


def day_coverage(spark, d):
    """Days of a civil range with and without orders."""
    days = instants.DayRange(dt.date(1996, 1, 1), dt.date(1998, 1, 1)).days(spark)
    o = read(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("jour")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(o, "jour", "left").select("jour", F.coalesce("n", F.lit(0)).alias("n"))


def checks(spark, d):
    """Row checks of lineitem in one pass, with severities (Q2, Q3, Q5, Q6, Q7)."""
    return quality.summary(read(spark, d, "lineitem"), [
        quality.Check("cle_absente", quality.is_null("l_orderkey")), quality.Check("etat_inconnu", quality.not_accepted("l_returnflag", ["A", "N"]), "warn"),
        quality.Check("quantite", quality.out_of_range("l_quantity", 1, 40)), quality.Check("remise", quality.out_of_range("l_discount", most=0.05), "warn"), quality.Check("longueur", quality.wrong_length("l_linestatus", 1)),
    ])


def duplicates(spark, d):
    return quality.not_unique(read(spark, d, "lineitem"), ["l_partkey", "l_suppkey"])


def label_orphans(spark, d):
    return quality.orphans(read(spark, d, "documents"), "doc_id", read(spark, d, "labels"), "doc_id").select("doc_id", "lang", "source")


def overlapping(spark, d):
    e = read(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 10).cast("int").alias("minutes"))
    one = e.groupBy("ts").agg(F.min("event_id").alias("event_id"), F.max("minutes").alias("minutes"))
    return windows.overlaps(one, "ts", "minutes").select("event_id", "ts", "minutes", "suivant")


def hierarchy(spark, d):
    a = bronze_areas(spark, d).withColumn("publie", F.when(F.right("code_iris", F.lit(1)) == "5", "00").otherwise(F.left("code_insee_commune", F.lit(2))))
    return quality.mismatched_hierarchy(a.withColumn("deduit", text.department_of(F.col("code_insee_commune"))), "deduit", "publie").select("annee", "code_iris", "deduit", "publie")


def freshness(spark, d):
    return quality.freshness(bronze_series(spark, d, NATIONAL_TR, 15), "date_heure", "taux_co2", F.lit(dt.datetime(2026, 4, 26, 6, tzinfo=dt.timezone.utc)), 2.0)


def month_cover(spark, d):
    return quality.month_coverage(bronze_series(spark, d, NATIONAL_CONS_DEF, 30), "date_heure", 30, F.lit(dt.date(2026, 4, 20)))


def ranked_customers(spark, d):
    """Ranks among positive balances only, by nation; and how many rows are ranked."""
    c = read(spark, d, "customer").groupBy("c_nationkey").agg((F.sum("c_acctbal") - 60 * F.count(F.lit(1)) * F.max("c_acctbal") / 150).alias("solde"))
    return c.withColumn("rang", windows.rank_where("solde", F.col("solde") > 0)).crossJoin(F.broadcast(c.agg(F.count(F.when(F.col("solde") > 0, 1)).alias("classes"))))


def shared(spark, name):
    """A new folder under the session's shared one; without that setting only for a session in one process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{(base or 'file:///tmp/gridmix-shared').rstrip('/')}/{name}-{uuid.uuid4().hex}"


EVENTS = Dataset("events_landed", ("ts", "event_id"), ("event_type",), ("value",), "ts", "date_format(ts, 'yyyy-MM-dd')")


def landed_events(spark, d):
    e = read(spark, d, "events")
    return e.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").cast("string").alias("event_id"), "event_type", "value", F.lit(LOADED).alias("ingested_at_utc"), F.lit("events").alias("source_dataset"))


def incremental(spark, d):
    """Events landed as three files and loaded by key as a stream that ends; then a late correction of one kind of
    event over days already loaded, in a second run (R1, R2); the resulting table."""
    base, e = shared(spark, "stream"), landed_events(spark, d)
    for part in (e.repartition(3), e.where("event_type = 'click'").withColumn("value", F.col("value") + 1)):
        part.write.mode("append").parquet(f"{base}/landing")
        load_landed(spark, base, EVENTS, f"{base}/landing", f"{base}/checkpoint").awaitTermination()
    return tables.bronze(spark, base, EVENTS).select("ts", "event_id", "event_type", "value")


def ingested(spark, d):
    """All text orders through conform, landing and upsert, twice, then an empty batch: figures of the three loads."""
    base = shared(spark, "ingest")
    records = order_records(spark, d)
    runs = [(records, "a"), (records, "b"), (records.limit(0), "c")]
    rows = []
    for i, (r, run) in enumerate(runs):
        x = upsert.ingest(spark, base, ORDERS, r, LOADED, run)
        rows.append((i, x["rows"], x["rows_inserted"], x["rows_updated"], x["records"], x["without_key"], x["in_gap"], x["unreadable"]["o_totalprice"], len(x["touched"])))
    stored = tables.bronze(spark, base, ORDERS)
    made = spark.createDataFrame(rows, "charge int, lignes long, inserees long, mises_a_jour long, lues long, sans_cle long, heure_inexistante long, illisibles long, dossiers long")
    return made.crossJoin(stored.agg(F.count(F.lit(1)).alias("en_base"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("montant")))  # three rows and one


def exported(spark, d):
    """Customers as a delimited export in several files, read back as texts."""
    folder = shared(spark, "export")
    c = read(spark, d, "customer").select("c_custkey", "c_name", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("c_acctbal"))
    c.repartition(3).write.option("sep", ";").option("header", True).csv(folder)
    return payloads.read_delimited(spark, folder).select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", text.to_measure(F.col("c_acctbal")).alias("c_acctbal"))


def rewritten_gold(spark, d):
    """A gold table written in full twice, then read back."""
    base = shared(spark, "gold")
    for _ in range(2):
        tables.write_full(read(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey"), base, "gold", "nations")
    return tables.gold(spark, base, "nations")


def texts_of(rows: DataFrame, spec: Dataset) -> DataFrame:
    """Typed rows as the records of an export: texts, instants with their offset."""
    as_text = lambda c, t: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'") if isinstance(t, T.TimestampType) else F.col(c).cast("string")
    return rows.select(*(as_text(f.name, f.dataType).alias(f.name) for f in rows.schema if f.name in spec.columns))


def series_records(spark, d) -> dict[Dataset, DataFrame]:
    return {NATIONAL_CONS_DEF: bronze_series(spark, d, NATIONAL_CONS_DEF, 30), NATIONAL_TR: bronze_series(spark, d, NATIONAL_TR, 15), TEMPO: bronze_tempo(spark, d)}


def load_all(spark, d, base):
    """All six datasets from text records through conform, landing and upsert."""
    others = {IRIS: bronze_areas(spark, d), BALANCE: bronze_balance(spark, d), CONSTRAINTS: bronze_constraints(spark, d)}
    return [upsert.ingest(spark, base, spec, texts_of(rows, spec), LOADED, "whole") for spec, rows in {**series_records(spark, d), **others}.items()]


#: A measure of each stored table whose sum is reported.
FIGURES = {
    "mix_temps_reel": "consommation", "mix_consolide": "consommation", "mix_unifie": "consommation", "jours_tempo": "length(couleur)", "conso_industrielle": "consommation_electricite_mwh", "equilibre_mensuel": "consommation_brute_mwh",
    "contraintes_reseau": "energie_non_evacuee_hiver_mwh", "production": "energie_mwh", "mix": "production_totale_mw", "mix_journalier": "consommation_gwh", "creneaux": "taux_co2_g_kwh", "cout_horaire": "cout_htva_eur", "cout_mensuel": "conso_kwh",
    "pression_commune": "consommation_electricite_mwh", "pression_departement": "consommation_electricite_mwh", "tension_region": "consommation_gwh", "territoire": "conso_industrielle_departement_gwh",
}


def rebuilt(spark, d):
    """All silver and gold tables from landed files, each stored once: rows and a sum of each table."""
    base = shared(spark, "rebuild")
    load_all(spark, d, base)
    rebuild.rebuild(spark, base)
    store = rebuild.Store(spark, base)
    sums = [store.read(n).agg(F.lit(n).alias("produit"), F.count(F.lit(1)).alias("lignes"), F.round(F.sum(F.expr(c)).cast("double"), 3).alias("somme")) for n, c in FIGURES.items()]
    return reduce(DataFrame.unionByName, sums)


def revised(spark, d):
    """Series loaded with figures that are wrong for some days, then those days again: gold slots after a refresh of
    the months that the second load touched, and how many months that was (R1, R2)."""
    base = shared(spark, "revised")
    late = F.col("date_heure").cast("timestamp_ntz") >= F.lit(dt.datetime(2026, 4, 8))
    wrong = lambda rows: rows.withColumns({c: F.when(late, F.col(c) + 1000).otherwise(F.col(c)) for c in ("consommation", "gaz", "taux_co2") if c in rows.columns})
    right = series_records(spark, d)
    for spec, rows in right.items():
        upsert.ingest(spark, base, spec, texts_of(wrong(rows), spec), LOADED, "wrong")
    whole = {spec.table: rebuild.WHOLE for spec in right}
    rebuild.refresh(spark, base, whole)
    touched = {spec.table: set(upsert.ingest(spark, base, spec, texts_of(rows.where(late), spec), LOADED, "right")["touched"]) for spec, rows in right.items() if spec is not TEMPO}
    done = rebuild.refresh(spark, base, touched)
    return rebuild.Store(spark, base).read("creneaux").withColumn("mois_refaits", F.lit(len(done["creneaux"])))


ORDERS_BY_MONTH = Dataset("orders_by_month", ("o_orderdate", "o_orderkey"), ("o_orderstatus",), ("o_totalprice",), "o_orderdate", by_month("o_orderdate"))


def reread(spark, d):
    """24 months of orders read again, of which one has been revised: what every month holds, and whether its folder was
    written again (R3)."""
    base = shared(spark, "reread")
    o = read(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    window = instants.TimeWindow.last_months(24, dt.datetime(1998, 5, 1, tzinfo=dt.timezone.utc))
    month = F.date_format("o_orderdate", "yyyy-MM")
    upsert.ingest(spark, base, ORDERS_BY_MONTH, texts_of(o, ORDERS_BY_MONTH), LOADED, "all")
    again = o.withColumn("o_totalprice", F.col("o_totalprice") + F.when(month == "1997-11", 1).otherwise(0))
    whole_months = F.date_trunc("month", F.lit(window.start) + F.make_dt_interval(days=F.lit(1)))  # folders are months in UTC
    done = upsert.ingest(spark, base, ORDERS_BY_MONTH, texts_of(again.where(F.col("o_orderdate") >= whole_months), ORDERS_BY_MONTH), LOADED + dt.timedelta(days=1), "again", instants.TimeWindow(window.start, window.end), skip_unchanged=True)
    stored = tables.bronze(spark, base, ORDERS_BY_MONTH).groupBy(month.alias("mois")).agg(F.count(F.lit(1)).alias("lignes"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("montant"))
    return stored.withColumns({"inchange": F.col("mois").isin(*done["unchanged"]), "ecrit": F.col("mois").isin(*done["touched"])})


def seeds_from_files(spark, d):
    """Departments and regions from edited CSV copies of the seeds, typed as declared, with the customers of each."""
    base = shared(spark, "seeds")
    for name in ("dim_departement", "dim_region"):
        seed(spark, name).coalesce(1).write.option("header", True).csv(f"{base}/{name}")
    departments, regions = (read_seed(spark, f"{base}/{name}", name) for name in ("dim_departement", "dim_region"))
    c = read(spark, d, "customer").groupBy(F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0").alias("code_departement")).agg(F.count(F.lit(1)).alias("clients"))
    return c.join(departments, "code_departement").join(regions, "code_insee_region").select("code_departement", "departement", "region", "est_zni", "clients")


def guarded(spark, d):
    """Loads with a window: rows outside it are left out; a dataset without instants is an error before any job."""
    base = shared(spark, "guard")
    window = instants.TimeWindow(dt.datetime(1996, 3, 1, tzinfo=dt.timezone.utc), dt.datetime(1997, 3, 1, tzinfo=dt.timezone.utc))
    o = texts_of(read(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp")), ORDERS_BY_MONTH)
    rows = []
    for spec, records in ((ORDERS_BY_MONTH, o), (BALANCE, texts_of(bronze_balance(spark, d), BALANCE))):
        try:
            done = upsert.ingest(spark, base, spec, records, LOADED, "window", window)
            rows.append((spec.name, False, done["records"], done["rows"]))
        except ValueError:
            rows.append((spec.name, True, None, None))
    made = spark.createDataFrame(rows, "jeu string, refuse boolean, lus long, charges long")
    return made.crossJoin(tables.bronze(spark, base, ORDERS_BY_MONTH).agg(F.min("o_orderdate").alias("premier"), F.max("o_orderdate").alias("dernier")))  # two rows and one


def ensured(spark, d):
    """Every bronze table exists after one dataset was loaded: which were made empty, and the rows of each (K4)."""
    base = shared(spark, "ensured")
    upsert.ingest(spark, base, NATIONAL_TR, texts_of(bronze_series(spark, d, NATIONAL_TR, 15), NATIONAL_TR), LOADED, "tr")
    made = tables.ensure_tables(spark, base)
    counts = [tables.bronze(spark, base, s).agg(F.lit(s.name).alias("jeu"), F.lit(s.table in made).alias("creee"), F.count(F.lit(1)).alias("lignes")) for s in DATASETS]
    return reduce(DataFrame.unionByName, counts)


def latest_complete_month(spark, d):
    """Orders by month and priority as a profile's monthly figures, some incomplete or without a cost: the last month that
    counts (F9, T4)."""
    o = read(spark, d, "orders").groupBy(F.trunc("o_orderdate", "MM").alias("mois")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("x"))
    m = F.month("mois")
    months = o.select(
        F.explode(F.array(F.lit("bureau_36kva"), F.lit("autre"))).alias("profil"), "mois", (m % 4 != 0).alias("est_complet"), F.col("n").cast("double").alias("conso_kwh"), (m / 12).alias("part_hc"), F.when(m % 4 != 3, F.col("x")).alias("cout_htva_eur"),
        *(F.col("n").cast("double").alias(c) for c in ("prix_moyen_htva_eur_kwh", "intensite_moyenne_g_kwh", "kwh_decales", "gain_decalage_eur", "co2_evite_kg")),
    )
    return territory.latest_priced_month(months.where("mois < date'1998-05-01' or profil = 'autre'"), seed(spark, "profils_consommation"))


def sorted_files(spark, d):
    """Whether the files of an upserted table are in order, and those of its rows written from last to first (P10)."""
    base = shared(spark, "sorted")
    o = read(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    upsert.ingest(spark, base, ORDERS_BY_MONTH, texts_of(o, ORDERS_BY_MONTH), LOADED, "all")
    stored = tables.parted(spark, base, ORDERS_BY_MONTH)
    stored.sortWithinPartitions(F.desc("o_orderkey")).write.parquet(f"{base}/reversed")
    rows = []
    for name, t, keys in (("base", stored, ["o_orderdate", "o_orderkey"]), ("inverse", spark.read.parquet(f"{base}/reversed"), ["o_orderkey"])):
        broken = quality.unsorted_files(t, keys).agg((F.count(F.lit(1)) == 0).alias("en_ordre"))
        rows.append(t.agg(F.lit(name).alias("jeu"), F.count(F.lit(1)).alias("lignes")).crossJoin(broken))  # one row each
    return reduce(DataFrame.unionByName, rows)


def month_report(spark, d):
    """The carbon section of one month, from stored slots of which only that month's folder is read."""
    base = shared(spark, "report")
    for spec, rows in series_records(spark, d).items():
        upsert.ingest(spark, base, spec, texts_of(rows, spec), LOADED, "all")
    rebuild.refresh(spark, base, {spec.table: rebuild.WHOLE for spec in (NATIONAL_CONS_DEF, NATIONAL_TR, TEMPO)})
    return rebuild.section(spark, base, "carbone", "2026-04", "2026-04")


def best_and_worst(spark, d):
    h = hourly(spark, d)
    return report.best_windows(h).withColumn("sens", F.lit("meilleur")).unionByName(report.worst_windows(h).withColumn("sens", F.lit("pire")))


def band_of_parts(spark, d):
    p = read(spark, d, "part").select(F.col("p_partkey").alias("site_id"), (F.col("p_retailprice") / 40).alias("puissance_mw"))
    return territory.connection_band(p, seed(spark, "seuils_raccordement")).select("site_id", "puissance_mw", "domaine_tension", "gestionnaire")


def supplier_terms(spark, d):
    """Line items priced by the terms of their supplier at the day of shipping: a grid of a row for each day on which a
    supplier's terms change, larger than what is broadcast (F5, J4, J6)."""
    items = read(spark, d, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("jour"), "l_quantity")
    changes = read(spark, d, "lineitem").where("l_linenumber = 1").groupBy(F.col("l_suppkey").alias("s"), F.to_date("l_shipdate").alias("debut")).agg(F.max("l_discount").alias("remise"))
    grid = changes.withColumn("fin", F.lead("debut").over(W.partitionBy("s").orderBy("debut")))  # some hundred changes a supplier
    priced = ranges.range_join(items, grid, "jour", "debut", "fin", ranges.by_month, {"l_suppkey": "s"})
    return priced.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("lignes"), F.count("remise").alias("avec_conditions"), F.sum((F.col("l_quantity") * F.col("remise")).cast("decimal(18,4)")).cast("double").alias("remises"))


def price_bands(spark, d):
    """Orders by bands of prices: a band for each part's price to the next one."""
    prices = read(spark, d, "part").select(F.col("p_retailprice").alias("bas")).distinct()
    bands = prices.withColumn("tranche", F.floor("bas")).groupBy("tranche").agg(F.min("bas").alias("bas"))
    bands = bands.withColumn("haut", F.lead("bas").over(W.partitionBy(F.floor(F.col("tranche") / 100)).orderBy("bas")))  # the last band of each hundred is open
    rows = read(spark, d, "orders").select((F.col("o_totalprice") / 100).alias("prix"))
    found = ranges.range_join(rows, bands, "prix", "bas", "haut", ranges.by_size, most=50)
    return found.groupBy("tranche").agg(F.count(F.lit(1)).alias("commandes"))


def price_quantiles(spark, d):
    """Exact quantiles of the prices of line items by return flag, by bins."""
    return quantiles.exact_quantile(read(spark, d, "lineitem"), "l_returnflag", "l_extendedprice", 0.9)


_BOUND: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "m11_hourly_slots": hourly,
    "m1_real_time": lambda s, d: real_time(s, d).drop("source_dataset", "ingested_at_utc", *(m for m in SHARED_MEASURES if m.startswith("ech_comm"))),
    "m2_consolidated": lambda s, d: consolidated(s, d).drop("source_dataset", "ingested_at_utc", *DETAIL_MEASURES, *(m for m in SHARED_MEASURES if m.startswith("ech_comm"))),
    "m3_unified": lambda s, d: mix(s, d).select("date_heure", "qualite", "rang_qualite", "pas_minutes", "consommation", *SOURCES, "taux_co2"),
    "m4_tempo_days": tempo,
    "m5_areas": areas,
    "m6_balance": lambda s, d: silver.monthly_balance(bronze_balance(s, d)),
    "m7_constraints": lambda s, d: silver.grid_constraints(bronze_constraints(s, d), seed(s, "dim_region")),
    "m8_production": production,
    "m9_mix": fct_mix,
    "m10_daily_mix": lambda s, d: gold.daily_mix(fct_mix(s, d)),
    "m12_profile_hours": profile_hours,
    "m13_profile_months": profile_months,
    "m14_commune_pressure": lambda s, d: territory.commune_pressure(areas(s, d)),
    "m15_department_pressure": pressure,
    "m16_region_tension": tension,
    "m17_territory": lambda s, d: territory.territory_diagnosis(pressure(s, d), tension(s, d)),
    "m18_sites": diagnosis,
    "m18_site_limits": lambda s, d: territory.site_limits(sites(s, d), seed(s, "limites_methodologiques")).drop("limite"),
    "m19_carbon_summary": lambda s, d: report.carbon_summary(hourly(s, d)),
    "m19_peak_hours": lambda s, d: report.peak_hours(hourly(s, d)).select("mois", "heure_utc", "taux_co2_g_kwh", "seuil_pic", "est_pic"),
    "m19_episodes": lambda s, d: report.peak_episodes(hourly(s, d)),
    "m19_worst_days": lambda s, d: report.worst_days(hourly(s, d), tempo(s, d)),
    "m20_tariffs": lambda s, d: report.tariff_summary(hourly(s, d)),
    "m20_hour_profile": lambda s, d: report.hour_profile(hourly(s, d)),
    "m20_colours": lambda s, d: report.colour_counts(tempo(s, d)).withColumn("jours_rouges_liste", F.array_join(F.transform("jours_rouges_liste", lambda x: x.cast("string")), ",")),
    "m21_windows": best_and_worst,
    "m22_saving": lambda s, d: report.flexible_saving(hourly(s, d)),
    "m23_coverage": lambda s, d: report.coverage(hourly(s, d), tempo(s, d)),
    "m24_heat_map": lambda s, d: report.heat_map(hourly(s, d)),
    "p1_conform": conformed,
    "p8_rejects": conform_rejects,
    "p6_repeated_hour": repeated_hour,
    "p11_civil_calendar": civil_calendar,
    "p15_labels_codes": labels_and_codes,
    "s2_paged_json": props_json,
    "s3_calendar": calendar_scan,
    "s4_geocoder": geocoder_scan,
    "s9_window": recent_events,
    "s11_months": month_windows,
    "s13_days": day_coverage,
    "k2_upsert": upserted,
    "k3_upsert_metrics": upsert_counts,
    "w3_ranks": ranked_customers,
    "j7_bands": band_of_parts,
    "q_checks": checks,
    "q1_duplicates": duplicates,
    "q4_orphans": label_orphans,
    "q8_overlaps": overlapping,
    "q9_hierarchy": hierarchy,
    "q10_freshness": freshness,
    "q11_month_coverage": month_cover,
    "r1_incremental": incremental,
    "m25_ingest": ingested,
    "s1_export": exported,
    "s8_gold_table": rewritten_gold,
    "k5_full_rebuild": rebuilt,
    "r2_late_revision": revised,
    "r3_reread": reread,
    "f4_month_report": month_report,
    "s6_seed_files": seeds_from_files,
    "s12_guard": guarded,
    "k4_tables": ensured,
    "f9_latest_month": latest_complete_month,
    "p10_sorted_files": sorted_files,
    "j4_supplier_terms": supplier_terms,
    "j7_price_bands": price_bands,
    "a17_quantiles": price_quantiles,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # Daily energies are multiples of 2.5e-6, so six digits would round halves.
    return {name: (lambda s, d, f=f, n=name: tidy(f(s, d), 8 if n == "m10_daily_mix" else 6)) for name, f in _BOUND.items()}
