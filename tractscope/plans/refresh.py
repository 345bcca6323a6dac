"""The periodic job: sources of one period into tables, all cities in one pass.

Raw incident files are landed once (``plans/landing.py``), as clean Parquet by city, file
version, year and month, and read again only when they change; a period is then a few
partitions of what has landed. Every mart is computed from clean tables, so a lost executor or a rerun costs a
small read, not the raw files again.
"""

import argparse
import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tractscope.catalog import Catalog, default_catalog
from tractscope.operators.tract_index import TractIndex, stored_tract_index
from tractscope.plans import incidents, loans, profile, schools
from tractscope.plans.landing import INCIDENT_SCHEMA, land_incidents, read_landed
from tractscope.session import write_once
from tractscope.sinks import swap
from tractscope.sinks.jdbc import replace_table
from tractscope.sinks.tables import (
    INCIDENT_PARTITIONS,
    LOAN_PARTITIONS,
    read_partitions,
    replace_partitions,
    write_incidents,
    write_loans,
)
from tractscope.sources.loans import read_loans
from tractscope.sources.schools import read_schools

LOAN_SCHEMA = (
    "city string, activity_year int, loan_amount double, census_tract string, income string, "
    "tract_population int, tract_owner_occupied_units int, tract_one_to_four_family_homes int"
)
MONTH_SCHEMA = "tract string, city string, year int, month int, total_count bigint"
YEAR_SCHEMA = "city string, tract string, year int, total_count bigint"
RANK_SCHEMA = (
    "city string, activity_year int, level int, census_tract string, count bigint, rank int"
)
DETAIL_SCHEMA = (
    "city string, activity_year int, loan_amount double, census_tract string, income string, "
    "income_int int, level int"
)
TRACT_INFO_SCHEMA = (
    "activity_year int, census_tract string, tract_population int, "
    "tract_owner_occupied_units int, tract_one_to_four_family_homes int"
)
SCHOOL_TABLE_SCHEMA = (
    "city string, name string, enrollment bigint, gradeRange string, gsRating bigint, "
    "lat double, lon double, tract string"
)

PROFILE_SCHEMA = (
    "tract string, year int, population int, owner_occupied_units int, "
    "one_to_four_family_homes int, incident_count bigint, crime_rate double, "
    "loan_count bigint, best_rank int, school_count bigint, average_rating double"
)
PUBLISHED = {
    "tract_info": TRACT_INFO_SCHEMA,
    "loan_detail": DETAIL_SCHEMA,
    "loan_ranks": RANK_SCHEMA,
    "incident_years": YEAR_SCHEMA,
    "schools": SCHOOL_TABLE_SCHEMA,
    "area_profile": PROFILE_SCHEMA,
}


def refresh_loans(spark: SparkSession, catalog: Catalog, root: str, out: str, year: int) -> None:
    """Loans of a year: clean table, tract facts, detail, and ranks.

    The marts are made from all cities the clean table has for the year, so a run for
    some cities leaves the facts of the others in place.
    """
    applications = read_loans(spark, catalog, root + catalog.loan_folder, [year])
    in_year = F.col("activity_year") == year
    mine = in_year & F.col("city").isin(list(catalog.cities))
    write_loans(loans.city_loans(applications, catalog, year), f"{out}/loans", owned=mine)
    fact = read_partitions(spark, f"{out}/loans", LOAN_SCHEMA, activity_year=year)
    info, info_path = loans.tract_info(fact), f"{out}/tract_info"
    replace_partitions(info, info_path, ["activity_year"], owned=in_year)
    detail = loans.loan_detail(fact)
    replace_partitions(detail, f"{out}/loan_detail", LOAN_PARTITIONS, owned=in_year)
    ranks = loans.tract_ranks(loans.level_counts(detail))
    replace_partitions(ranks, f"{out}/loan_ranks", LOAN_PARTITIONS, owned=in_year)


def _in_run(catalog: Catalog, year, month=None) -> Column:
    """The partitions a run answers for: its cities and its period."""
    mine = F.col("city").isin(list(catalog.cities))
    if incidents.is_given(year):
        mine = mine & (F.col("year") == int(year))
        if incidents.is_given(month):
            mine = mine & (F.col("month") == int(month))
    return mine


def refresh_incidents(
    spark: SparkSession, catalog: Catalog, index: TractIndex, root: str, out: str, year, month
) -> None:
    """Reports of a month (or year): clean table, month counts, and the year's totals."""
    land_incidents(spark, catalog, root, out)
    mine = _in_run(catalog, year, month)
    landed = read_landed(spark, out).where(mine)
    write_incidents(landed, f"{out}/incidents", owned=mine)
    fact = read_partitions(spark, f"{out}/incidents", INCIDENT_SCHEMA)
    months = incidents.tract_months(fact.where(mine), index)
    replace_partitions(months, f"{out}/incident_months", INCIDENT_PARTITIONS, owned=mine)
    whole_years = _in_run(catalog, year)
    all_months = read_partitions(spark, f"{out}/incident_months", MONTH_SCHEMA).where(whole_years)
    totals, totals_path = incidents.years_of_months(all_months), f"{out}/incident_years"
    replace_partitions(totals, totals_path, ["city", "year"], owned=whole_years)


def refresh_schools(
    spark: SparkSession, catalog: Catalog, index: TractIndex, root: str, out: str
) -> None:
    """All schools of the cities anew. Years of tracts whose figures change are noted for the
    profile."""
    table = write_once(schools.school_tracts(read_schools(spark, catalog, root), index), "schools")
    mine = F.col("city").isin(list(catalog.cities))
    before = read_partitions(spark, f"{out}/schools", SCHOOL_TABLE_SCHEMA)
    after = before.where(~mine).unionByName(table)
    old, new = (schools.schools_by_tract(t) for t in (before, after))
    changed = old.exceptAll(new).unionByName(new.exceptAll(old)).select("tract").distinct()
    note_years(spark, out, _years_of(spark, out, write_once(changed, "changed-tracts")))
    replace_partitions(table, f"{out}/schools", ["city"], owned=mine)


def _years_of(spark: SparkSession, out: str, tracts: DataFrame) -> list[int]:
    """Years in which any of the tracts is in the profile's tables."""
    info = read_partitions(spark, f"{out}/tract_info", TRACT_INFO_SCHEMA)
    counts = read_partitions(spark, f"{out}/incident_years", YEAR_SCHEMA)
    ranks = read_partitions(spark, f"{out}/loan_ranks", RANK_SCHEMA)
    tract, year = F.col("census_tract").alias("tract"), F.col("activity_year").alias("year")
    areas = info.select(tract, year).union(ranks.select(tract, year))
    areas = areas.union(counts.select("tract", "year")).join(tracts, "tract", "left_semi")
    return sorted(r.year for r in areas.select("year").distinct().collect() if r.year is not None)


def note_years(spark: SparkSession, out: str, years) -> None:
    """Years whose profile has to be made anew; None stands for all.

    They are noted before the tables change, so that no change is lost if a run fails.
    """
    if years:
        rows = spark.createDataFrame([(year,) for year in years], "year int").coalesce(1)
        rows.write.mode("append").parquet(f"{out}/profile_changes")


def refresh_profile(spark: SparkSession, out: str) -> list[int] | None:
    """The combined table, from the tables the other steps have written: the years that have
    changed since it was last made. Returns these, or None for all.

    Only the partitions of these years are read and written.
    """
    changes = read_partitions(spark, f"{out}/profile_changes", "year int").distinct().collect()
    years = sorted(r.year for r in changes if r.year is not None)
    whole = len(years) < len(changes) or not swap.Folders(spark, f"{out}/area_profile").exists("")
    if not whole and not years:
        return []

    def of_years(name, schema, column):
        table = read_partitions(spark, f"{out}/{name}", schema)
        return table if whole else table.where(F.col(column).isin(years))

    info = of_years("tract_info", TRACT_INFO_SCHEMA, "activity_year")
    counts = of_years("incident_years", YEAR_SCHEMA, "year")
    ranks = of_years("loan_ranks", RANK_SCHEMA, "activity_year")
    school_table = read_partitions(spark, f"{out}/schools", SCHOOL_TABLE_SCHEMA)
    combined = profile.area_profile(
        loans.tract_population(info), counts, ranks, schools.schools_by_tract(school_table)
    )
    owned = F.lit(True) if whole else F.col("year").isin(years)
    replace_partitions(combined, f"{out}/area_profile", ["year"], owned=owned)
    swap.Folders(spark, f"{out}/profile_changes").delete("")
    return None if whole else years


def published_tables(with_loans: bool, with_profile: bool) -> list[str]:
    """The tables a run has changed and a dashboard reads."""
    loan_tables = ["tract_info", "loan_detail", "loan_ranks"] if with_loans else []
    return loan_tables + ["incident_years", "schools"] + ["area_profile"] * with_profile


def publish(spark: SparkSession, out: str, tables: list[str], url: str, properties=None) -> None:
    """Replace the relational copies of finished tables."""
    for name in tables:
        table = read_partitions(spark, f"{out}/{name}", PUBLISHED[name])
        replace_table(table, url, name, properties)


def refresh(spark, catalog, root, out, year, month, with_loans: bool) -> None:
    """One period of all cities; loans come out yearly, so not every run has them."""
    note_years(spark, out, [int(year) if incidents.is_given(year) else None])
    if with_loans:
        refresh_loans(spark, catalog, root, out, year)
    index = stored_tract_index(spark.read.parquet(f"{root}tracts"))
    refresh_incidents(spark, catalog, index, root, out, year, month)
    refresh_schools(spark, catalog, index, root, out)


def main(arguments=None) -> None:
    parser = argparse.ArgumentParser(description="Refresh the tract tables for one period.")
    parser.add_argument("--source", required=True, help="folder of the raw files, ending in /")
    parser.add_argument("--target", required=True, help="folder of the tables")
    parser.add_argument("--year", type=int, required=True)
    parser.add_argument("--month", type=int)
    parser.add_argument("--cities", help="comma-separated keys; all cities if left out")
    parser.add_argument("--catalog", help="catalog file (JSON)")
    parser.add_argument("--with-loans", action="store_true", help="also outside January")
    parser.add_argument("--profile", action="store_true", help="also build the area profile")
    parser.add_argument("--jdbc-url", help="publish the marts to this database")
    parser.add_argument("--jdbc-properties", help="JSON file of user, password, driver, ...")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("tractscope").getOrCreate()
    catalog = Catalog.load(spark, given.catalog) if given.catalog else default_catalog()
    if given.cities:
        catalog = catalog.only(given.cities.split(","))
    with_loans = given.with_loans or given.month == 1
    refresh(spark, catalog, given.source, given.target, given.year, given.month, with_loans)
    if given.profile:
        refresh_profile(spark, given.target)
    if given.jdbc_url:
        properties = None
        if given.jdbc_properties:
            with open(given.jdbc_properties) as file:
                properties = json.load(file)
        tables = published_tables(with_loans, given.profile)
        publish(spark, given.target, tables, given.jdbc_url, properties)
