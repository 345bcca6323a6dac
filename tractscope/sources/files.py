"""Delimited text, XML and year folders. No source infers types: texts stay texts."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tractscope.sources.headers import read_by_header, read_checked, text_schema


def read_csv_header(spark: SparkSession, path, columns=None) -> DataFrame:
    """CSV files with a header line each; every column is a string."""
    return read_delimited(spark, path, ",", columns)


def read_csv_schema(spark: SparkSession, path, schema) -> DataFrame:
    """CSV without header lines; the schema names the columns, short rows get nulls."""
    return spark.read.csv(path, header=False, schema=schema)


def read_delimited(spark: SparkSession, path, delimiter="|", columns=None) -> DataFrame:
    """Delimited text with a header line; every column is a string, ``06075`` included.

    The header lines of all files are read first, in one scan. Files with the same columns in
    another order are read by their own header, and rows meet by column name; files with other
    columns are an error. Names that are left out or repeated are completed as Spark's reader
    does. With ``columns`` given, no header is read up front, and a file with another header
    fails when it is read.
    """
    reader = spark.read.option("header", True).option("sep", delimiter)
    if columns is not None:
        return reader.schema(text_schema(columns)).option("enforceSchema", False).csv(path)
    rows = read_by_header(spark, path, delimiter)
    return reader.csv(path) if rows is None else rows


def read_delimited_checked(spark: SparkSession, path, delimiter=",") -> tuple[DataFrame, DataFrame]:
    """The rows as above, and (file, line, reason) of those that do not parse."""
    return read_checked(spark, path, delimiter)


def is_absent(error: AnalysisException) -> bool:
    """Whether a read failed only because there is nothing at the path."""
    return error.getCondition() == "PATH_NOT_FOUND"


def read_xml_rows(spark: SparkSession, path, row_tag, schema, root_tag="rows") -> DataFrame:
    """One row per ``row_tag`` element, typed by the given schema."""
    reader = spark.read.format("xml").option("rootTag", root_tag).option("rowTag", row_tag)
    return reader.schema(schema).load(path)


def year_paths(prefix: str, years) -> list[str]:
    """All files in the folders ``<prefix><year>``."""
    return [f"{prefix}{year}/*" for year in years]


def years_glob(prefix: str, years) -> str:
    """The same as one pattern; folders that do not exist match nothing."""
    return f"{prefix}{{{','.join(str(year) for year in years)}}}/*"
