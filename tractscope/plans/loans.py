"""Loan applications: eligibility, city, tract facts, detail, and ranks.

All cities and years go through one plan. Counting is combined on the map side, so
the shuffles carry one row per tract, level and year at most, whatever the volume.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tractscope.catalog import Catalog
from tractscope.functions.income import has_income, income_level
from tractscope.functions.numbers import is_code, parse_int
from tractscope.functions.tracts import normalize_tract
from tractscope.operators.ranking import rank_by_count, top_ranked

TRACT_FACTS = ["tract_population", "tract_owner_occupied_units", "tract_one_to_four_family_homes"]
LOAN_FACTS = ["activity_year", "loan_amount", "census_tract", "income", *TRACT_FACTS]


def _granted_purchase() -> Column:
    return is_code(F.col("action_taken"), 1) & is_code(F.col("loan_purpose"), 1)


def _home_v1() -> Column:
    return is_code(F.col("property_type"), 1)


def _home_v2() -> Column:
    return F.col("derived_dwelling_category").like("Single Family%")


def eligible_v1() -> Column:
    return _granted_purchase() & _home_v1()


def eligible_v2() -> Column:
    return _granted_purchase() & _home_v2()


ELIGIBLE = {"v1": eligible_v1, "v2": eligible_v2}


def eligible_loans(raw: DataFrame) -> DataFrame:
    """Eligible rows of a table that holds both layouts, marked in ``layout``.

    Each layout names its county in its own way; ``county_key`` holds that name.
    """
    is_v1 = F.col("layout") == "v1"
    county_key = F.when(is_v1, F.col("county_name")).otherwise(F.col("county_code"))
    home = F.when(is_v1, _home_v1()).otherwise(_home_v2())
    return raw.where(_granted_purchase() & home).select(
        "layout", county_key.alias("county_key"), *LOAN_FACTS
    )


def city_loans(loans: DataFrame, catalog: Catalog, year: int | None = None) -> DataFrame:
    """Loans of the catalog's cities with full tract identifiers and typed columns.

    The county dimension has unique keys, so no loan is doubled; it is broadcast if it has
    few rows.
    """
    counties = catalog.county_dim(loans.sparkSession)
    typed = loans.join(counties, ["layout", "county_key"]).select(
        "city",
        parse_int(F.col("activity_year")).alias("activity_year"),
        F.col("loan_amount").try_cast("double").alias("loan_amount"),
        normalize_tract(F.col("census_tract"), F.col("county_code")).alias("census_tract"),
        "income",
        *(parse_int(F.col(name).cast("string")).alias(name) for name in TRACT_FACTS),
    )
    return typed if year is None else typed.where(F.col("activity_year") == year)


def tract_info(loans: DataFrame) -> DataFrame:
    """Distinct facts per year and tract; a tract repeats where its facts differ."""
    return loans.select("activity_year", "census_tract", *TRACT_FACTS).distinct()


def loan_detail(loans: DataFrame) -> DataFrame:
    """Loans with a readable income, and its level."""
    return (
        loans.select(
            "city", "activity_year", "loan_amount", "census_tract", "income",
            parse_int(F.col("income")).alias("income_int"),
        )
        .where(has_income(F.col("income_int")))
        .withColumn("level", income_level(F.col("income_int")))
    )


def level_counts(detail: DataFrame) -> DataFrame:
    """Loans per city, year, income level and tract; a missing tract is its own group."""
    return detail.groupBy("city", "activity_year", "level", "census_tract").count()


def tract_ranks(counts: DataFrame) -> DataFrame:
    """Popularity of tracts within a city, year and income level."""
    return rank_by_count(counts, ["city", "activity_year", "level"])


def top_tracts(ranks: DataFrame, k: int) -> DataFrame:
    return top_ranked(ranks, k)


def tract_population(info: DataFrame) -> DataFrame:
    """One row per tract and year: the largest of the facts reported for it."""
    return (
        info.where(F.col("census_tract").isNotNull())
        .groupBy(F.col("census_tract").alias("tract"), F.col("activity_year").alias("year"))
        .agg(*(F.max(name).alias(name) for name in TRACT_FACTS))
    )
