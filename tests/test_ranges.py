"""Range joins by buckets against the broadcast join, exact quantiles against Spark's percentile."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridmix.operators import quantiles, ranges
from gridmix.plans import report

RELAXED = {"max_examples": 6, "deadline": None, "suppress_health_check": [HealthCheck.function_scoped_fixture]}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(str, df.collect()))


def both(rows, table, *args, **more):
    one, other = (ranges.range_join(rows, table, *args, most=most, **more) for most in (ranges.MOST, 1))
    assert rows_of(one) == rows_of(other.select(*one.columns)) and one.columns == other.columns
    return other


def test_grids_with_validity(spark):
    rng = random.Random(2)
    day = lambda: dt.date(2015, 1, 1) + dt.timedelta(days=rng.randrange(4000))
    grid = []
    for k in "abc":
        cuts = sorted({day() for _ in range(12)})
        grid += [(k, a, b, rng.random()) for a, b in zip(cuts, [*cuts[1:], None])]
    grid += [("a", dt.date(2018, 1, 1), dt.date(2019, 1, 1), 7.0), ("a", dt.date(2019, 1, 1), dt.date(2018, 1, 1), 8.0), ("b", None, None, 9.0)]  # overlapping, upside down, without a start
    facts = [(i, rng.choice(["a", "b", "c", "z", None]), day() if i % 9 else None) for i in range(500)] + [(900, "a", dt.date(2099, 1, 1)), (901, "a", dt.date(1999, 1, 1)), *[(902, "b", dt.date(2020, 5, 5))] * 40]
    rows = spark.createDataFrame(facts, "id int, k string, jour date")
    table = spark.createDataFrame(grid, "k string, debut date, fin date, prix double")
    for how in ("left", "inner"):
        out = both(rows, table, "jour", "debut", "fin", ranges.by_month, on={"k": "k"}, how=how)
        text = plan_of(out)
        assert "NestedLoop" not in text and "Cartesian" not in text and text.count("BroadcastExchange") == 0 or "SortMergeJoin" in text
    assert out.where("id = 900").count() == 1 and out.where("id = 902").count() == 40


def test_bands(spark):
    rng = random.Random(4)
    cuts = sorted({round(rng.uniform(-50, 50) ** 3, 3) for _ in range(60)} | {0.0, 1e-30, 5e8})
    bands = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(cuts, [*cuts[1:], None]))], "band int, low double, high double")
    values = [*cuts, *(c - 1e-9 for c in cuts), *(rng.uniform(-60, 60) ** 3 for _ in range(300)), 1e12, None]
    both(spark.createDataFrame([(v,) for v in values], "x double"), bands, "x", "low", "high", ranges.by_size)


@settings(**RELAXED)
@given(st.lists(st.floats(-1e300, 1e300), min_size=2, max_size=30))
def test_buckets_never_fall(spark, values):
    got = [r[0] for r in spark.createDataFrame([(v,) for v in sorted(values)], "x double").coalesce(1).select(ranges.by_size(F.col("x"))).collect()]
    assert got == sorted(got)


@settings(**RELAXED)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.sampled_from([1.0, 2.0, 2.5]), st.floats(-1e6, 1e6))), max_size=60), st.sampled_from([0.0, 0.1, 0.5, 0.9, 1.0]))
def test_quantiles(spark, rows, q):
    df = spark.createDataFrame(rows, "g string, v double")
    want = {r["g"]: r["x"] for r in df.where("v is not null").groupBy("g").agg(F.percentile("v", q).alias("x")).collect()}
    for bins in (3, quantiles.BINS):
        got = {r["g"]: r["quantile"] for r in quantiles.exact_quantile(df, "g", "v", q, bins).collect()}
        assert got == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_sections_by_bins(spark):
    rng = random.Random(3)
    rows = [(dt.datetime(2026, 1 + i % 3, 1 + i % 28, i % 24), dt.date(2026, 1 + i % 3, 1), rng.choice([None, 10.0, rng.uniform(0, 99)])) for i in range(400)]
    slots = spark.createDataFrame(rows, "heure_utc timestamp, mois date, taux_co2_g_kwh double")
    one, other = report.carbon_summary(slots), report.carbon_summary(slots, by_bins=True)
    assert one.columns == other.columns and rows_of(one) == rows_of(other)
    with pytest.raises(ValueError):
        quantiles.exact_quantile(slots, "mois", "taux_co2_g_kwh", 1.5)
