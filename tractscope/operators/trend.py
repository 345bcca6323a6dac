"""Change from one year to the next."""

from pyspark.sql import DataFrame, Window, functions as F


def yearly_trend(counts: DataFrame, groups: list[str]) -> DataFrame:
    """Compare ``total_count`` with the year before; a gap year leaves nulls.

    A window partition has one row per year of the group. Counts without a year sort
    first and follow nothing; they are taken out afterwards, because a filter before
    the window would be pushed down to the scan and parse every date a second time.
    """
    window = Window.partitionBy(*groups).orderBy("year")
    follows = F.lag("year").over(window) == F.col("year") - 1
    previous = F.when(follows, F.lag("total_count").over(window))
    change = F.col("total_count") - F.col("previous_count")
    return (
        counts.withColumn("previous_count", previous)
        .withColumn("change", change)
        .withColumn(
            "direction",
            F.when(change > 0, "up").when(change < 0, "down").when(change == 0, "same"),
        )
        .where(F.col("year").isNotNull())
    )
