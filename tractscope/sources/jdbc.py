"""Relational tables as sources. Connection details are arguments, never environment."""

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url, properties=None, split=None) -> dict[str, str]:
    """Options shared by all reads.

    ``split`` is (column, lower, upper, partitions): without it the whole table comes
    through one connection into one task, so give it for anything but small tables.
    """
    options = {"url": url, **(properties or {})}
    if split is not None:
        column, lower, upper, partitions = split
        options["partitionColumn"] = column
        options["lowerBound"] = str(lower)
        options["upperBound"] = str(upper)
        options["numPartitions"] = str(partitions)
    return options


def read_jdbc_table(spark: SparkSession, url, table, properties=None, split=None) -> DataFrame:
    """A table; Spark pushes filters and column choice into the database."""
    options = jdbc_options(url, properties, split)
    return spark.read.format("jdbc").options(dbtable=table, **options).load()


def read_jdbc_query(spark: SparkSession, url, query, properties=None) -> DataFrame:
    """The result of a SELECT that the database runs."""
    options = jdbc_options(url, properties)
    return spark.read.format("jdbc").options(query=query, **options).load()
