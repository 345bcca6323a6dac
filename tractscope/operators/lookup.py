"""County of a city, found by the beginning of its name."""

from pyspark.sql import DataFrame, functions as F

# The table writes a county as "<name> CA"; the last three characters go.
_SUFFIX = 3


def lookup_counties(requests: DataFrame, places: DataFrame) -> DataFrame:
    """For each (city, state): county of the first place whose name starts with city.

    First means smallest (name, county, code). Requests without a match get empty
    texts. Every place offers the beginnings of its name, in the lengths that were
    asked for, as equi-join keys: the join hashes on (state, beginning) instead of
    comparing every pair, each key meets one request at most, and matches are reduced
    before they are shuffled.
    """
    wanted = requests.select("city", "state").distinct()
    lengths = wanted.agg(F.collect_set(F.length("city"))).scalar()
    offers = (
        places.select(
            "state",
            F.struct("cityname", "countyname", "countycode").alias("place"),
            F.explode(lengths).alias("letters"),
        )
        .where(F.col("letters") <= F.length("place.cityname"))
        .withColumn("city", F.col("place.cityname").substr(F.lit(1), F.col("letters")))
    )
    first = (
        offers.join(wanted, ["city", "state"])
        .groupBy("city", "state")
        .agg(F.min("place").alias("place"))
    )
    name = F.col("place.countyname")
    return wanted.join(first, ["city", "state"], "left").select(
        "city",
        "state",
        F.coalesce(name.substr(F.lit(1), F.length(name) - _SUFFIX), F.lit("")).alias("county_name"),
        F.coalesce(F.col("place.countycode"), F.lit("")).alias("county_code"),
    )
