"""Schools with their tract, and schools per tract."""

from pyspark.sql import DataFrame, functions as F

from tractscope.operators.locate import attach_tract
from tractscope.operators.tract_index import TractIndex

SCHOOL_COLUMNS = ["name", "enrollment", "gradeRange", "gsRating", "lat", "lon"]


def school_tracts(schools: DataFrame, index: TractIndex) -> DataFrame:
    extra = [name for name in ["city"] if name in schools.columns]
    return attach_tract(schools.select(*extra, *SCHOOL_COLUMNS), index, x="lon", y="lat")


def schools_by_tract(schools: DataFrame) -> DataFrame:
    """Figures per tract; the schools themselves are rows of ``school_tracts``."""
    return schools.groupBy("tract").agg(
        F.count("*").alias("school_count"),
        F.sum("enrollment").alias("total_enrollment"),
        F.avg("gsRating").alias("average_rating"),
    )
