"""Text, codes and measures."""

from __future__ import annotations

import re
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with marks and their plain forms; three cities whose districts have codes of their own.
MARKED = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿÀÂÄÁÃÅÇÉÈÊËÍÌÎÏÑÓÒÔÖÕÚÙÛÜÝŸ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUYY"
CITY_OF_DISTRICT = {"751": "75056", "693": "69123", "132": "13055"}
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(inf|infinity|nan)$"


def clean_text(c: Column) -> Column:
    """Trimmed, empty as null."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def to_measure(c: Column, boolean: bool = False) -> Column:
    """Double of a text or number; unreadable and blank texts and booleans give null."""
    if boolean:
        return F.lit(None).cast("double")
    t = clean_text(c)
    return F.when(F.lower(t).rlike(NUMBER), t.try_cast("double"))


def is_unreadable(c: Column) -> Column:
    """A measure that has a text but no value."""
    return clean_text(c).isNotNull() & to_measure(c).isNull()


def plain_letters(c: Column) -> Column:
    return F.translate(c, MARKED, PLAIN)


def normal_label(c: Column) -> Column:
    """Lower case, without marks and without anything but letters and digits."""
    return F.regexp_replace(F.lower(plain_letters(c)), "[^a-z0-9]", "")


def quality_of(nature: Column) -> Column:
    folded = F.lower(plain_letters(nature))
    return F.when(folded.like("%definitive%"), "definitive").when(folded.like("%consolidee%"), "consolidee").otherwise("temps_reel")


def quality_rank(quality: Column) -> Column:
    return F.when(quality == "definitive", 3).when(quality == "consolidee", 2).otherwise(1)


def department_of(commune: Column) -> Column:
    return F.when(F.left(commune, F.lit(2)) == "97", F.left(commune, F.lit(3))).otherwise(F.left(commune, F.lit(2)))


def _city(prefix: Column) -> Column:
    out = F.lit(None).cast("string")
    for district, city in CITY_OF_DISTRICT.items():
        out = F.when(prefix == district, city).otherwise(out)
    return out


def rebuilt_commune(published: Column, area: Column) -> Column:
    """The published commune, or the one that the padded code of a small area says."""
    return F.coalesce(published, _city(F.left(area, F.lit(3))), F.left(area, F.lit(5)))


def parent_commune(code: Column) -> Column:
    """The city of a district of five characters, else the code itself."""
    return F.when(F.length(code) == 5, F.coalesce(_city(F.left(code, F.lit(3))), code)).otherwise(code)


def tempo_colour(value: Column) -> Column:
    return F.when(value == "BLUE", "bleu").when(value == "WHITE", "blanc").when(value == "RED", "rouge")


def month_date(month: Column) -> Column:
    """First day of a month given as YYYY-MM."""
    return F.to_date(F.concat(month, F.lit("-01")), "yyyy-MM-dd")


def context_parts(value: Column) -> Column:
    """struct(code, departement, region) of "code, department, region" or "region"-like texts of two parts; null with fewer."""
    parts = F.filter(F.transform(F.split(value, ","), lambda x: F.trim(x)), lambda x: x != "")
    n = F.size(parts)
    last = F.element_at(parts, -1)
    middle = F.when(n >= 3, F.get(parts, F.lit(1))).otherwise(last)
    return F.when(n >= 2, F.struct(F.get(parts, F.lit(0)).alias("code"), middle.alias("departement"), last.alias("region")))


def sum_of(columns: list[str]) -> Column:
    """Sum of columns, nulls as zero."""
    return reduce(add, [F.coalesce(F.col(c), F.lit(0.0)) for c in columns])


def safe_run_id(run_id: str) -> str:
    return re.sub(r"[^A-Za-z0-9_.-]+", "-", run_id).strip("-") or "run"


def energy_mwh(power_mw: Column, minutes: Column) -> Column:
    return power_mw * minutes / F.lit(60.0)


def balance_status(cover: Column) -> Column:
    return F.when(cover >= 1, "excedentaire").when(cover < 1, "deficitaire")


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean of value by weight over the rows that have a value; null without weight."""
    return F.sum(value * weight) / F.nullif(F.sum(F.when(value.isNotNull(), weight)), F.lit(0.0))
