"""Census tract identifiers."""

from pyspark.sql import Column, functions as F

UNKNOWN_TRACT = "n/a"
FULL_LENGTH = 11


def normalize_tract(tract: Column, county_code: Column) -> Column:
    """``0101.00`` in county ``06075`` is ``06075010100``; full identifiers stay."""
    keep = tract.isNull() | (F.length(tract) == FULL_LENGTH)
    return F.when(keep, tract).otherwise(
        F.concat(county_code, F.replace(tract, F.lit("."), F.lit("")))
    )


def tract_or_unknown(tract: Column) -> Column:
    return F.coalesce(tract, F.lit(UNKNOWN_TRACT))
