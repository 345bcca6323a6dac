"""Ranks within groups."""

from pyspark.sql import DataFrame, Window, functions as F


def rank_by_count(counts: DataFrame, groups: list[str], count="count") -> DataFrame:
    """Competition rank, highest count first: ties share a rank and leave a gap.

    ``counts`` is already aggregated to one row per member of a group, so a window
    partition is as long as the group has members, however many records they have.
    """
    window = Window.partitionBy(*groups).orderBy(F.desc(count))
    return counts.withColumn("rank", F.rank().over(window))


def top_ranked(ranked: DataFrame, k: int) -> DataFrame:
    """All members ranked k or better; Spark then limits each group before the shuffle."""
    return ranked.where(F.col("rank") <= k)
