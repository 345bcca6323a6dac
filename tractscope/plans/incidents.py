"""Incident reports: cleaning, period, counts per tract, rates and trends."""

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tractscope.catalog import Catalog
from tractscope.functions.dates import parse_date_by
from tractscope.operators.locate import count_by_tract
from tractscope.operators.tract_index import TractIndex
from tractscope.operators.trend import yearly_trend

INCIDENT_COLUMNS = ["city", "year", "month", "date", "category", "latitude", "longitude"]


def is_given(value) -> bool:
    return value is not None and value != ""


def with_day(reports: DataFrame, catalog: Catalog, name: str = "day") -> DataFrame:
    """Reports of mixed sources with the calendar day of their ``date``.

    The pattern comes with the joined source row, so the plan grows with the number of
    patterns and not of cities. Reports of no known source have no day.
    """
    sources = catalog.incident_source_dim(reports.sparkSession)
    formats = [(F.col("date_format") == p, p) for p in catalog.date_formats()]
    return (
        reports.join(sources.select("city", "version", "date_format"), ["city", "version"], "left")
        .withColumn(name, parse_date_by(F.col("date"), formats))
        .drop("date_format")
    )


def clean_incidents(
    reports: DataFrame, date: Column, year=None, month=None, keep=()
) -> DataFrame:
    """Located reports with year and month of ``date``; an unreadable date leaves nulls.

    A period is tested on the date as a whole: the test is pushed down to the raw rows,
    where each mention of year or month would parse the text once more.
    """
    located = reports.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())
    dated = located.withColumn("_day", date)
    if is_given(year):
        unit = "month" if is_given(month) else "year"
        first = datetime.date(int(year), int(month) if is_given(month) else 1, 1)
        dated = dated.where(F.trunc("_day", unit) == F.lit(first))
    return dated.withColumns({"year": F.year("_day"), "month": F.month("_day")}).select(
        *INCIDENT_COLUMNS, *keep
    )


def in_period(incidents: DataFrame, year=None, month=None) -> DataFrame:
    """Reports of a year, or of a month in it; a month without a year says nothing.

    For tables that store year and month, where this picks partitions.
    """
    if not is_given(year):
        return incidents
    period = F.col("year") == int(year)
    if is_given(month):
        period = period & (F.col("month") == int(month))
    return incidents.where(period)


def sort_by_location(incidents: DataFrame) -> DataFrame:
    """Order by coordinate texts. The row number only lets a coordinate with very many
    reports be split over several range partitions."""
    return (
        incidents.withColumn("_row", F.monotonically_increasing_id())
        .orderBy("longitude", "latitude", "_row")
        .drop("_row")
    )


def tract_months(incidents: DataFrame, index: TractIndex) -> DataFrame:
    """Reports per city, tract and month: the fact that later totals are summed from."""
    return count_by_tract(incidents, index, ["city", "year", "month"])


def tract_years(incidents: DataFrame, index: TractIndex) -> DataFrame:
    return count_by_tract(incidents, index, ["city", "year"])


def years_of_months(months: DataFrame) -> DataFrame:
    """Yearly totals of a month fact, the same as counting the year at once."""
    return months.groupBy("city", "tract", "year").agg(F.sum("total_count").alias("total_count"))


def incident_rates(years: DataFrame, population: DataFrame) -> DataFrame:
    """Reports per inhabitant; null where the population is unknown or zero."""
    people = population.select("tract", "year", F.col("tract_population").alias("population"))
    return years.join(people, ["tract", "year"], "left").withColumn(
        "crime_rate", F.try_divide(F.col("total_count"), F.col("population"))
    )


def incident_trend(years: DataFrame) -> DataFrame:
    return yearly_trend(years, ["city", "tract"])


def existing_periods(requested: DataFrame, incidents: DataFrame) -> DataFrame:
    """Those requested (city, year, month) for which reports exist."""
    present = incidents.select("city", "year", "month").distinct()
    return requested.join(present, ["city", "year", "month"], "left_semi")
