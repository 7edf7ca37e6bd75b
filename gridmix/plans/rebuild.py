"""The silver and gold tables as one stored build, whole or for some months.

Each table is made once, from stored ones, and written under its layer. Series are split into folders by month: silver
ones by the month of their instants in UTC, like bronze tables, gold ones and days by the month in Paris. Which months
of a table a change reaches follows from its inputs: a month of an input reaches the same month and up to ``lag`` later
ones (the last hours of a month in UTC belong to the next one in Paris; a tariff day ends on the next morning). A
refresh reads only these months of the inputs, with the ``lag`` earlier ones, and replaces only their folders. The cut
between the two qualities of the series moves with the last consolidated row, so the months between the old and the new
cut are made anew as well. Territory tables have few rows and are made whole, if any of their inputs changed.

A refresh that was interrupted is repeated from the start: every step replaces what an earlier run wrote. One writer at
a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridmix.functions.instants import paris_day
from gridmix.plans import gold, report, silver, territory
from gridmix.sources import tables
from gridmix.sources.seeds import seed
from gridmix.specs import BALANCE, CONSTRAINTS, IRIS, NATIONAL_CONS_DEF, NATIONAL_TR, PART, TEMPO, Dataset, layer_path

#: Column of the month that splits stored series, as yyyy-MM.
MONTH = "_mois"
#: Stands for all months of a table.
WHOLE = None
Months = set[str] | None


@dataclass(frozen=True)
class Product:
    """A stored table: what makes it of its inputs and seeds, and the month of a row, if it is split."""

    name: str
    layer: str
    make: Callable[..., DataFrame]
    inputs: tuple[tuple[str, int], ...]
    seeds: tuple[str, ...] = ()
    month: Callable[[], Column] | None = None


def _month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


_by_instant = lambda: _month(F.col("date_heure"))
_by_day = lambda: _month(F.col("jour"))
_by_month = lambda: _month(F.col("mois"))
BRONZE: dict[str, Dataset] = {d.table: d for d in (NATIONAL_TR, NATIONAL_CONS_DEF, TEMPO, IRIS, BALANCE, CONSTRAINTS)}
#: In order of building. Inputs are stored tables with the months by which their rows may come late here.
PRODUCTS = (
    Product("mix_temps_reel", "silver", lambda b: silver.measured_series(b, 15), ((NATIONAL_TR.table, 0),), month=_by_instant),
    Product("mix_consolide", "silver", lambda b: silver.measured_series(b, 30, details=True), ((NATIONAL_CONS_DEF.table, 0),), month=_by_instant),
    Product("mix_unifie", "silver", silver.unified, (("mix_consolide", 0), ("mix_temps_reel", 0)), month=_by_instant),
    Product("jours_tempo", "silver", silver.tempo_days, ((TEMPO.table, 1),), month=lambda: _month(F.col("jour_tempo"))),
    Product("conso_industrielle", "silver", silver.industrial_areas, ((IRIS.table, 0),), ("dim_departement",)),
    Product("equilibre_mensuel", "silver", silver.monthly_balance, ((BALANCE.table, 0),)),
    Product("contraintes_reseau", "silver", silver.grid_constraints, ((CONSTRAINTS.table, 0),), ("dim_region",)),
    Product("production", "gold", gold.production_by_source, (("mix_unifie", 1),), ("dim_filiere",), _by_day),
    Product("mix", "gold", gold.mix_table, (("mix_unifie", 1), ("production", 0)), month=_by_day),
    Product("mix_journalier", "gold", gold.daily_mix, (("mix", 0),), month=_by_day),
    Product("creneaux", "gold", gold.hourly_slots, (("mix", 0), ("jours_tempo", 1)), ("tarifs_tempo",), _by_month),
    Product("cout_horaire", "gold", gold.hourly_profile_cost, (("creneaux", 0),), ("profils_consommation", "tarifs_hphc"), _by_month),
    Product("cout_mensuel", "gold", gold.monthly_profile_cost, (("cout_horaire", 0),), month=_by_month),
    Product("pression_commune", "gold", territory.commune_pressure, (("conso_industrielle", 0),)),
    Product("pression_departement", "gold", territory.department_pressure, (("conso_industrielle", 0),), ("dim_departement",)),
    Product("tension_region", "gold", territory.region_tension, (("equilibre_mensuel", 0), ("contraintes_reseau", 0)), ("dim_region",)),
    Product("territoire", "gold", territory.territory_diagnosis, (("pression_departement", 0), ("tension_region", 0))),
)
BY_NAME = {p.name: p for p in PRODUCTS}
#: Sections of the monthly report: what makes them of hourly slots, and whether they need the days' colours.
SECTIONS: dict[str, tuple[Callable[..., DataFrame], bool]] = {
    "carbone": (report.carbon_summary, False), "heures_de_pointe": (report.peak_hours, False), "episodes": (report.peak_episodes, False), "pires_jours": (report.worst_days, True), "tarifs": (report.tariff_summary, False),
    "profil_horaire": (report.hour_profile, False), "meilleures_fenetres": (report.best_windows, False), "pires_fenetres": (report.worst_windows, False), "gain_flexible": (report.flexible_saving, False),
    "couverture": (report.coverage, True), "carte_de_chaleur": (report.heat_map, False),
}


def later(months: Iterable[str], by: int) -> set[str]:
    """Months and those up to ``by`` later ones (earlier ones, if it is negative)."""
    out = set()
    for m in months:
        n = int(m[:4]) * 12 + int(m[5:7]) - 1
        out |= {f"{k // 12:04d}-{k % 12 + 1:02d}" for k in range(n + min(by, 0), n + max(by, 0) + 1)}
    return out


def between(first: str, last: str) -> set[str]:
    return later({first}, (int(last[:4]) - int(first[:4])) * 12 + int(last[5:7]) - int(first[5:7]))


class Store:
    """Stored tables under one folder, by name."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def path(self, p: Product) -> str:
        return layer_path(self.base, p.layer, p.name)

    def read(self, name: str, months: Months = WHOLE) -> DataFrame:
        """A table, or some of its months: the filter is on the column that splits it."""
        if name in BRONZE:
            rows, split = tables.parted(self.spark, self.base, BRONZE[name]), PART
            return (rows if months is WHOLE else rows.where(F.col(split).isin(*months))).drop(split)
        p = BY_NAME[name]
        rows = tables.stored(self.spark, self.base, p.layer, name)
        if p.month is None:
            return rows
        return (rows if months is WHOLE else rows.where(F.col(MONTH).isin(*months))).drop(MONTH)

    def last_instant(self, name: str):
        """The latest instant of a stored series, from its last folder; None if there is no row."""
        try:
            rows = tables.stored(self.spark, self.base, BY_NAME[name].layer, name)
        except tables.MissingTable:
            return None
        month = rows.agg(F.max(MONTH)).first()[0]
        return rows.where(F.col(MONTH) == month).agg(F.max("date_heure")).first()[0] if month else None

    def write(self, p: Product, rows: DataFrame, months: Months) -> None:
        """Replaces a table, or the folders of some months; of these, folders that no row calls for any more go."""
        if p.month is None:
            rows.write.mode("overwrite").option("compression", "zstd").parquet(self.path(p))
            return
        rows, seen = rows.withColumn(MONTH, p.month()), Observation()
        if months is not WHOLE:
            rows = rows.where(F.col(MONTH).isin(*months)).observe(seen, *(F.count(F.when(F.col(MONTH) == m, 1)).alias(m) for m in sorted(months)))
        out = rows.hint("rebalance", MONTH).write.mode("overwrite").option("compression", "zstd").partitionBy(MONTH)
        if months is WHOLE:
            out.option("partitionOverwriteMode", "static").parquet(self.path(p))
            return
        out.option("partitionOverwriteMode", "dynamic").parquet(self.path(p))
        found = tables.seen(seen)
        for m in months:
            if not found.get(m):
                tables.drop_folder(self.spark, f"{self.path(p)}/{MONTH}={m}")


def reached(p: Product, changed: dict[str, Months]) -> tuple[bool, Months]:
    """(whether a table has to be made, for which months)."""
    hit = [(changed[name], lag) for name, lag in p.inputs if name in changed]
    if not hit or p.month is None or any(m is WHOLE for m, _ in hit):
        return bool(hit), WHOLE
    return True, set().union(*(later(m, lag) for m, lag in hit))


def made(store: Store, p: Product, months: Months) -> DataFrame:
    """A table's rows, of stored inputs: for some months from these and the earlier ones that may hold their rows."""
    own = [store.read(name, WHOLE if months is WHOLE else later(months, -lag)) for name, lag in p.inputs]
    if p.name == "mix_unifie":
        own.append(store.spark.createDataFrame([(store.last_instant("mix_consolide"),)], "date_heure timestamp"))
    return p.make(*own, *(seed(store.spark, s) for s in p.seeds))


def refresh(spark: SparkSession, base: str, changed: dict[str, Months]) -> dict[str, Months]:
    """Makes anew what changes of bronze tables reach: bronze names with the folders that changed, WHOLE for all.
    Returns the tables that were written, with their months."""
    store, done = Store(spark, base), {}
    changed = {name: months if BRONZE[name].time else WHOLE for name, months in changed.items() if months is WHOLE or months}
    cut = store.last_instant("mix_consolide")
    for p in PRODUCTS:
        needed, months = reached(p, changed)
        if p.name == "mix_unifie" and "mix_consolide" in changed:
            now = store.last_instant("mix_consolide")
            if cut is None or now is None:
                needed, months = True, WHOLE
            elif needed and months is not WHOLE and now != cut:
                months = months | between(*sorted(t.strftime("%Y-%m") for t in (cut, now)))
        if needed:
            if months is not WHOLE and not tables.exists(spark, base, p.layer, p.name):
                months = WHOLE
            store.write(p, made(store, p, months), months)
            changed[p.name] = done[p.name] = months
    return done


def rebuild(spark: SparkSession, base: str) -> dict[str, Months]:
    """All silver and gold tables from all bronze rows."""
    return refresh(spark, base, {name: WHOLE for name in BRONZE})


def section(spark: SparkSession, base: str, name: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """A section of the monthly report from the stored slots, for the months (yyyy-MM) from first to last; without
    them for all. Other months' folders are not read."""
    make, coloured = SECTIONS[name]

    def own(table: str) -> DataFrame:
        rows = tables.stored(spark, base, BY_NAME[table].layer, table)
        for edge, holds in ((first, F.col(MONTH).__ge__), (last, F.col(MONTH).__le__)):
            rows = rows.where(holds(F.lit(edge))) if edge else rows
        return rows.drop(MONTH)

    return make(own("creneaux"), *([own("jours_tempo")] if coloured else []))
