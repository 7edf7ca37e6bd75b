"""Scans of raw exports and stored API payloads. All give text columns; typing follows in operators.conform."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix.functions.text import context_parts
from gridmix.specs import Dataset

COLOURS = ("BLUE", "WHITE", "RED")
#: Geocoder scores below this are flagged, and results coarser than a street or house.
LEAST_SCORE = 0.4
PRECISE = ("housenumber", "street")

CALENDAR = T.StructType([T.StructField("tempo_like_calendars", T.StructType([T.StructField("values", T.ArrayType(T.StructType([T.StructField("start_date", T.StringType()), T.StructField("value", T.StringType())])))]))])
_PROPERTIES = T.StructType([T.StructField(n, T.DoubleType() if n == "score" else T.StringType()) for n in ("label", "score", "type", "citycode", "city", "postcode", "context")])
GEOCODER = T.StructType([T.StructField("features", T.ArrayType(T.StructType([T.StructField("geometry", T.StructType([T.StructField("coordinates", T.ArrayType(T.DoubleType()))])), T.StructField("properties", _PROPERTIES)])))])


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """A ``;`` separated export with a header: every value a text, empty as null, a byte order mark dropped. _seq is the
    order of arrival: by file name, and by place in the file."""
    rows = spark.read.option("sep", ";").option("header", True).csv(path)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return rows.withColumn("_seq", place)


def records_of_pages(pages: DataFrame, spec: Dataset, payload: str = "value", order: str = "page") -> DataFrame:
    """Records of paged JSON payloads (results[] of each page) as texts; _seq is the page and the record's place in it."""
    record = T.MapType(T.StringType(), T.StringType())
    schema = T.StructType([T.StructField("results", T.ArrayType(record))])
    rows = pages.select(order, F.posexplode(F.from_json(payload, schema)["results"]).alias("pos", "r"))
    return rows.select(*(F.col("r")[c].alias(c) for c in spec.columns), F.struct(F.col(order).alias("page"), "pos").alias("_seq"))


def calendar_days(payloads: DataFrame, payload: str = "value") -> DataFrame:
    """date_heure and couleur of calendar payloads, known colours only."""
    days = payloads.select(F.explode(F.from_json(payload, CALENDAR)["tempo_like_calendars"]["values"]).alias("d"))
    return days.select(F.col("d.start_date").alias("date_heure"), F.col("d.value").alias("couleur")).where(F.col("couleur").isin(*COLOURS))


def geocoded(responses: DataFrame, regions: DataFrame, payload: str = "value", least_score: float = LEAST_SCORE) -> DataFrame:
    """The first feature of each stored geocoder response, flat. ``erreur`` says why a response gives no territory
    (introuvable: no feature; sans_commune: no commune code; contexte: fewer than two parts) and is null otherwise. A
    missing score is 0 and a missing precision is coarse; both are flagged."""
    from gridmix.functions.text import normal_label

    f = F.get(F.from_json(payload, GEOCODER)["features"], F.lit(0))
    p = f["properties"]
    flat = responses.select(
        *(c for c in responses.columns if c != payload), f.isNull().alias("_none"), p["label"].alias("adresse"), F.when(f.isNotNull(), F.coalesce(p["score"], F.lit(0.0))).alias("score"), p["type"].alias("precision"),
        p["citycode"].alias("code_insee_commune"), p["city"].alias("commune"), p["postcode"].alias("code_postal"), f["geometry"]["coordinates"][0].alias("longitude"), f["geometry"]["coordinates"][1].alias("latitude"), context_parts(p["context"]).alias("_c"),
    )
    error = F.when(F.col("_none"), "introuvable").when(F.coalesce("code_insee_commune", F.lit("")) == "", "sans_commune").when(F.col("_c").isNull(), "contexte")
    flat = flat.select("*", error.alias("erreur"), F.col("_c.code").alias("code_departement"), F.col("_c.departement").alias("departement"), F.col("_c.region").alias("region"))
    coarse = ~F.coalesce("precision", F.lit("")).isin(*PRECISE)
    flat = flat.withColumns({"score_faible": F.col("score") < least_score, "precision_grossiere": F.when(~F.col("_none"), coarse)}).drop("_c", "_none")
    known = F.broadcast(regions.select(normal_label(F.col("region")).alias("_label"), "code_insee_region"))  # 18 rows
    return flat.withColumn("_label", normal_label(F.col("region"))).join(known, "_label", "left").drop("_label")
