"""Relational tables as targets; Spark creates a table that is absent."""

from pyspark.sql import DataFrame


def jdbc_writer(df: DataFrame, url, table, properties=None, connections=8):
    """At most ``connections`` tasks write at once, so the database is not swamped."""
    options = {"url": url, "dbtable": table, "batchsize": "10000", **(properties or {})}
    return df.write.format("jdbc").options(numPartitions=str(connections), **options)


def append_table(df: DataFrame, url, table, properties=None) -> None:
    """Add rows. A task that is run again after its commit adds them again, so the
    Parquet tables stay the record and marts are replaced rather than appended to."""
    jdbc_writer(df, url, table, properties).mode("append").save()


def replace_table(df: DataFrame, url, table, properties=None) -> None:
    """Replace all rows, keeping the table's definition, grants and indexes."""
    jdbc_writer(df, url, table, properties).option("truncate", "true").mode("overwrite").save()
