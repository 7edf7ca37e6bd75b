"""Instants, Paris wall-clock time and civil periods. Sessions run in UTC."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PARIS = "Europe/Paris"
HAS_OFFSET = r"([zZ]|[+-]\d\d:?\d\d)$"


def to_paris(instant: Column) -> Column:
    """Paris wall-clock time of an instant, as timestamp_ntz."""
    return F.convert_timezone(F.current_timezone(), F.lit(PARIS), instant.cast("timestamp_ntz"))


def from_paris(local: Column) -> Column:
    """Instant of a Paris wall-clock time; a repeated time gives its first occurrence."""
    return F.convert_timezone(F.lit(PARIS), F.current_timezone(), local.cast("timestamp_ntz")).cast("timestamp")


def paris_day(instant: Column) -> Column:
    return F.to_date(to_paris(instant))


def month_of(day: Column) -> Column:
    return F.trunc(day, "MM")


def iso_weekday(day: Column) -> Column:
    return F.weekday(day) + 1


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MINUTE", start, end)


def day_hours(day: Column) -> Column:
    """Hours of a civil day in Paris: 23, 24 or 25."""
    return minutes_between(from_paris(day), from_paris(F.date_add(day, 1))) / F.lit(60.0)


def month_start(day: Column) -> Column:
    return from_paris(month_of(day))


def month_end(day: Column) -> Column:
    """Exclusive end of a civil month in Paris."""
    return from_paris(F.add_months(month_of(day), 1))


def month_hours(day: Column) -> Column:
    return (minutes_between(month_start(day), month_end(day)) / F.lit(60)).cast("long")


def month_slots(day: Column, minutes: int) -> Column:
    return (minutes_between(month_start(day), month_end(day)) / F.lit(minutes)).cast("long")


def tariff_period(local_hour: Column) -> Column:
    """hc from 22:00 to 06:00, else hp."""
    return F.when((local_hour >= 22) | (local_hour < 6), "hc").otherwise("hp")


def tempo_day(day: Column, local_hour: Column) -> Column:
    """The tariff day runs from 06:00 to 06:00."""
    return F.when(local_hour < 6, F.date_sub(day, 1)).otherwise(day)


def day_type(weekday: Column) -> Column:
    return F.when(weekday <= 5, "ouvre").otherwise("week_end")


def parse_aware(text: Column) -> Column:
    """Instant of a text with an offset or Z; null for all else. Seconds and the offset's colon may be left out."""
    full = F.regexp_replace(text, r"([T ]\d\d:\d\d)([zZ]|[+-]\d\d:?\d\d)$", "$1:00$2")
    full = F.regexp_replace(full, r"([+-]\d\d)(\d\d)$", "$1:$2")
    return F.when(text.rlike(HAS_OFFSET), full.try_cast("timestamp"))


def parse_local(text: Column) -> Column:
    """Wall-clock time of a text without an offset; null for all else."""
    return F.when(~text.rlike(HAS_OFFSET), text.try_cast("timestamp_ntz"))


def does_not_exist(local: Column) -> Column:
    """True for the hour that the spring change leaves out: no instant has this wall-clock time."""
    return to_paris(from_paris(local)) != local


def resolve_instants(df: DataFrame, column: str, groups: list[str], order: str = "_seq") -> DataFrame:
    """Replaces a text column by instants; adds ``_gap``, true where a local time doesn't exist.

    Texts with an offset are taken as they are. A local time of the repeated October hour is the first occurrence
    unless a row of the same series and date arrived before with the same or a later time; from then on the second.
    Windows are cut by series and local date, so a long series isn't one task.
    """
    hour = F.make_dt_interval(hours=F.lit(1))
    df = df.withColumns({"_aware": parse_aware(F.col(column)), "_local": parse_local(F.col(column))})
    df = df.withColumn("_first", from_paris(F.col("_local")))
    df = df.withColumn("_twice", F.coalesce(to_paris(F.col("_first") + hour) == F.col("_local"), F.lit(False)))
    day = F.coalesce(F.to_date("_local"), paris_day(F.col("_aware")))
    series = W.partitionBy(*groups, day).orderBy(order)
    known = F.coalesce("_aware", "_first")
    reset = F.col("_twice") & (F.col("_first") <= F.lag(known).over(series))
    df = df.withColumn("_reset", F.coalesce(reset, F.lit(False)))
    second = F.max("_reset").over(series.rowsBetween(W.unboundedPreceding, W.currentRow)) & F.col("_twice")
    df = df.withColumn("_second", second)
    instant = F.coalesce("_aware", F.when(F.col("_second"), F.col("_first") + hour).otherwise(F.col("_first")))
    gap = F.coalesce(does_not_exist(F.col("_local")), F.lit(False))
    return df.withColumns({column: instant, "_gap": gap}).drop("_aware", "_local", "_first", "_twice", "_reset", "_second")


@dataclass(frozen=True)
class TimeWindow:
    """Half-open window [start, end) of instants; both ends are aware and it isn't empty."""

    start: dt.datetime
    end: dt.datetime

    def __post_init__(self):
        if self.start.tzinfo is None or self.end.tzinfo is None:
            raise ValueError("a window needs aware instants")
        if self.start >= self.end:
            raise ValueError("a window must not be empty")

    @classmethod
    def last_hours(cls, hours: int, now: dt.datetime) -> TimeWindow:
        return cls(now - dt.timedelta(hours=hours), now)

    @classmethod
    def last_months(cls, months: int, now: dt.datetime) -> TimeWindow:
        """From the start of the Paris month ``months`` before that of now, up to now."""
        from zoneinfo import ZoneInfo

        local = now.astimezone(ZoneInfo(PARIS))
        at = local.year * 12 + local.month - 1 - months
        return cls(dt.datetime(at // 12, at % 12 + 1, 1, tzinfo=ZoneInfo(PARIS)).astimezone(dt.timezone.utc), now)

    def holds(self, column: str) -> Column:
        return (F.col(column) >= F.lit(self.start)) & (F.col(column) < F.lit(self.end))


@dataclass(frozen=True)
class DayRange:
    """Half-open range [start, end) of civil days."""

    start: dt.date
    end: dt.date

    @classmethod
    def month(cls, year: int, month: int, day_before: bool = False) -> DayRange:
        start = dt.date(year, month, 1)
        end = dt.date(year + month // 12, month % 12 + 1, 1)
        return cls(start - dt.timedelta(days=1) if day_before else start, end)

    def chunks(self, most: int = 366) -> list[DayRange]:
        out, at = [], self.start
        while at < self.end:
            to = min(self.end, at + dt.timedelta(days=most))
            out.append(DayRange(at, to))
            at = to
        return out

    def until_tomorrow(self, today: dt.date) -> DayRange:
        """Cut so that the last day is the one after today."""
        return DayRange(self.start, min(self.end, today + dt.timedelta(days=2)))

    def days(self, spark) -> DataFrame:
        last = self.end - dt.timedelta(days=1)
        if last < self.start:
            return spark.createDataFrame([], "jour date")
        return spark.range(1).select(F.explode(F.sequence(F.lit(self.start), F.lit(last))).alias("jour"))
