"""Everything known about an area and year, in one table."""

from pyspark.sql import DataFrame, functions as F

# State, county and tract digits; other texts ("06075NA", "n/a") name no area.
AREA = "^[0-9]{11}$"


def area_profile(
    population: DataFrame, incident_years: DataFrame, ranks: DataFrame, schools: DataFrame
) -> DataFrame:
    """One row per tract and year that any of the yearly tables knows.

    The inputs are aggregates of at most one row per tract and year (and level), so
    these joins move dimension-sized data. Loans without a readable tract and reports
    outside all tracts belong to no area.
    """
    crime = incident_years.groupBy("tract", "year").agg(
        F.sum("total_count").alias("incident_count")
    )
    loans = ranks.groupBy(
        F.col("census_tract").alias("tract"), F.col("activity_year").alias("year")
    ).agg(F.sum("count").alias("loan_count"), F.min("rank").alias("best_rank"))
    areas = population.join(crime, ["tract", "year"], "full").join(
        loans, ["tract", "year"], "full"
    )
    return (
        areas.where(F.col("tract").rlike(AREA))
        .where(F.col("year").isNotNull())
        .join(schools, "tract", "left")
        .select(
            "tract",
            "year",
            F.col("tract_population").alias("population"),
            F.col("tract_owner_occupied_units").alias("owner_occupied_units"),
            F.col("tract_one_to_four_family_homes").alias("one_to_four_family_homes"),
            "incident_count",
            F.try_divide(F.col("incident_count"), F.col("tract_population")).alias("crime_rate"),
            "loan_count",
            "best_rank",
            "school_count",
            "average_rating",
        )
    )
