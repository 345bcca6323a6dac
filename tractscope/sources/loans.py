"""Loan applications of a year, in the file layout of that year."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tractscope.catalog import Catalog
from tractscope.operators.columns import map_columns
from tractscope.plans.loans import ELIGIBLE
from tractscope.sources.files import is_absent, read_csv_header, read_delimited, years_glob
from tractscope.sources.headers import text_schema

# Column that says which county a loan belongs to, and the reader, per layout.
COUNTY_COLUMN = {"v1": "county_name", "v2": "county_code"}
READER = {"v1": read_csv_header, "v2": read_delimited}
# Columns that eligibility is decided by, per layout.
CODES = {
    "v1": ["action_taken", "loan_purpose", "property_type"],
    "v2": ["action_taken", "loan_purpose", "derived_dwelling_category"],
}


def standard_loans(raw: DataFrame, catalog: Catalog, version: str) -> DataFrame:
    """Eligible applications of one layout under the common column names."""
    county = COUNTY_COLUMN[version]
    mapped = map_columns(
        raw.where(ELIGIBLE[version]()), catalog.loan_layouts[version].columns, keep=[county]
    )
    return mapped.withColumnRenamed(county, "county_key").withColumn("layout", F.lit(version))


def _of_layout(spark: SparkSession, catalog: Catalog, root: str, version: str, years) -> DataFrame:
    try:
        raw = READER[version](spark, years_glob(root, years))
    except AnalysisException as error:
        if not is_absent(error):
            raise
        columns = [*CODES[version], COUNTY_COLUMN[version]]
        columns += catalog.loan_layouts[version].columns.values()
        raw = spark.createDataFrame([], text_schema(columns))
    return standard_loans(raw, catalog, version)


def read_loans(spark: SparkSession, catalog: Catalog, root: str, years) -> DataFrame:
    """Eligible applications of all given years, each layout read once.

    Years without a folder, and no years at all, have no applications.
    """
    by_version = {version: [] for version in sorted(catalog.loan_layouts)}
    for year in years:
        by_version[catalog.loan_versions.of_year(year)].append(year)
    parts = [
        _of_layout(spark, catalog, root, version, chosen or ["none"])
        for version, chosen in by_version.items()
        if chosen or not years
    ]
    return reduce(DataFrame.unionByName, parts)
