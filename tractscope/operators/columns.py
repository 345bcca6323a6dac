"""Versioned renaming of source columns."""

from pyspark.sql import DataFrame, functions as F


def map_columns(df: DataFrame, columns: dict[str, str], keep=()) -> DataFrame:
    """One projection from source names to target names, plus columns kept as they are.

    A mapped column the source lacks is an error here, not a null or a surprise later.
    Upper and lower case do not matter, as in Spark itself.
    """
    present = {name.lower() for name in df.columns}
    missing = [name for name in [*columns.values(), *keep] if name.lower() not in present]
    if missing:
        raise ValueError(f"source columns not found: {missing}")
    renamed = [F.col(f"`{source}`").alias(target) for target, source in columns.items()]
    return df.select(*renamed, *(F.col(f"`{name}`") for name in keep))
