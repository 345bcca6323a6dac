"""School listings, one XML file per city."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tractscope.catalog import Catalog
from tractscope.sources.files import read_xml_rows

SCHOOL_SCHEMA = StructType(
    [
        StructField("name", StringType()),
        StructField("enrollment", LongType()),
        StructField("gradeRange", StringType()),
        StructField("gsRating", LongType()),
        StructField("lat", DoubleType()),
        StructField("lon", DoubleType()),
    ]
)


def read_school_file(spark: SparkSession, path) -> DataFrame:
    return read_xml_rows(spark, path, "school", SCHOOL_SCHEMA, root_tag="schools")


def read_schools(spark: SparkSession, catalog: Catalog, root: str) -> DataFrame:
    parts = [
        read_school_file(spark, root + city.school_file).withColumn("city", F.lit(city.key))
        for city in catalog.cities.values()
        if city.school_file
    ]
    return reduce(DataFrame.unionByName, parts)
