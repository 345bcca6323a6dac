"""Tract of a coordinate: equi-join on the grid cell, then an exact test.

Two plans give the same rows. While the index is small enough to broadcast, every
point is answered where it is read: no shuffle, so no hot key either. Beyond that,
only distinct coordinates meet the index in a salted shuffle join, and the answers
are joined back with the heavy coordinates kept out of the shuffle.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tractscope.functions.tracts import tract_or_unknown
from tractscope.operators.tract_index import (
    TractIndex,
    cell_key,
    cell_number,
    entry_encloses,
)
from tractscope.session import write_once

# A coordinate with more than 1/MAX_HEAVY of all rows is heavy; there are fewer than
# MAX_HEAVY of them whatever the data, so their list may always be broadcast.
MAX_HEAVY = 100_000

SALTS = 16

# Fewer distinct coordinates than this in a cell are no load worth spreading.
MIN_DENSE = 10_000


def _degrees(value: Column) -> Column:
    """Number of a coordinate text, null when unreadable; NaN is no place either."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def _with_cell(df: DataFrame, index: TractIndex, x: str, y: str, broadcast: bool) -> DataFrame:
    """``df`` with its numbers ``_x`` and ``_y`` and the key ``cell`` of its index cell.

    The cell is the coarse one, or in a coarse cell that is cut, the finer one; finer
    numbers are kept inside their coarse cell, whatever rounding does at its borders.
    """
    size = index.cell_size
    levels = F.broadcast(index.levels) if broadcast else index.levels
    column, row = cell_number(F.col("_x"), size), cell_number(F.col("_y"), size)
    parts = F.call_function("shiftleft", F.lit(1), F.col("level"))

    def finer(value, number):
        sub = F.floor((value - number * F.lit(size)) / (F.lit(size) / parts))
        return number * parts + F.greatest(F.lit(0), F.least(sub, parts - 1))

    fine = cell_key(F.col("level"), finer(F.col("_x"), column), finer(F.col("_y"), row))
    return (
        df.withColumns({"_x": _degrees(F.col(x)), "_y": _degrees(F.col(y))})
        .withColumn("coarse", cell_key(0, column, row))
        .join(levels, "coarse", "left")
        .withColumn("cell", F.when(F.col("level").isNull(), F.col("coarse")).otherwise(fine))
        .drop("coarse", "level")
    )


def _found_tract() -> Column:
    """The smallest matching tract of the cell's candidates, or null."""
    matching = F.filter("candidates", lambda c: entry_encloses(c, F.col("_x"), F.col("_y")))
    smallest = F.array_min(F.transform(matching, lambda c: c.tract))
    return F.coalesce(F.col("sole_tract"), smallest)


def distinct_coordinates(df: DataFrame, x="longitude", y="latitude") -> DataFrame:
    return df.select(x, y).distinct()


def attach_tract(df: DataFrame, index: TractIndex, x="longitude", y="latitude") -> DataFrame:
    """All rows of ``df`` with the column ``tract``; ``n/a`` where no tract matches."""
    if index.fits_broadcast:
        joined = _with_cell(df, index, x, y, True).join(F.broadcast(index.cells), "cell", "left")
        return joined.select(
            *(F.col(name) for name in df.columns),
            tract_or_unknown(_found_tract()).alias("tract"),
        )
    points = df.groupBy(x, y).agg(F.count("*").alias("copies"))
    located = write_once(_locate_points(points, index, x, y), "located-points")
    return attach_located(df, located, x, y)


def count_by_tract(
    df: DataFrame, index: TractIndex, keys: list[str], x="longitude", y="latitude"
) -> DataFrame:
    """Rows per tract and ``keys`` as ``total_count``.

    Map-side combine shrinks a hot tract, or the large ``n/a`` group, to one row per
    task. Without broadcast, rows are first counted per coordinate, so a hot
    coordinate is one row per key before anything is joined.
    """
    if index.fits_broadcast:
        total = F.count("*")
        located = attach_tract(df.select(*keys, x, y), index, x, y)
    else:
        total = F.sum("copies")
        per_point = df.groupBy(x, y, *keys).agg(F.count("*").alias("copies"))
        counted = write_once(per_point, "counted-points")
        points = _locate_points(distinct_coordinates(counted, x, y), index, x, y)
        located = _join_points(counted, points, x, y)
    return located.groupBy("tract", *keys).agg(total.alias("total_count"))


def _locate_points(points: DataFrame, index: TractIndex, x: str, y: str) -> DataFrame:
    """Tract per distinct coordinate by a shuffle join on cell and salt.

    The points are distinct. Cells with more than 1/MAX_HEAVY of them are dense, and there
    are fewer than MAX_HEAVY such cells; their points are spread over salts, and only their
    index entries are copied for each salt. Coordinates without a cell get keys of their
    own that match nothing.
    """
    spread = F.hash(x, y)
    placed = write_once(_with_cell(points, index, x, y, False), "placed-points")
    counts = placed.where(F.col("cell").isNotNull()).groupBy("cell").agg(F.count("*").alias("n"))
    total = placed.count()
    heavy = counts.where(F.col("n") > max(total / MAX_HEAVY, MIN_DENSE)).select("cell")
    dense = write_once(heavy, "dense-cells").withColumn("dense", F.lit(True))
    salt = F.when(F.col("dense"), F.pmod(spread, F.lit(SALTS))).otherwise(0).cast("int")
    salted_points = (
        placed.join(F.broadcast(dense), "cell", "left")
        .withColumns({"salt": salt, "cell": F.coalesce("cell", -1 - F.abs(spread).cast("long"))})
        .drop("dense")
    )
    salts = F.when(F.col("dense"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(
        F.array(F.lit(0))
    )
    salted_cells = (
        index.cells.join(F.broadcast(dense), "cell", "left")
        .withColumn("salt", F.explode(salts))
        .drop("dense")
    )
    joined = salted_points.join(salted_cells, ["cell", "salt"], "left")
    return joined.select(
        *(F.col(name) for name in points.columns),
        tract_or_unknown(_found_tract()).alias("tract"),
    )


def _join_points(df: DataFrame, located: DataFrame, x: str, y: str) -> DataFrame:
    """Left join on the coordinate texts; ``located`` has one row per coordinate."""
    joined = df.join(located.select(x, y, "tract"), [x, y], "left")
    return joined.select(
        *(F.col(name) for name in df.columns), tract_or_unknown(F.col("tract")).alias("tract")
    )


def attach_located(df: DataFrame, located: DataFrame, x="longitude", y="latitude") -> DataFrame:
    """Left join of rows to their coordinate's tract, safe for heavy coordinates.

    ``located`` has ``copies``, the number of rows per coordinate. Coordinates with
    more than 1/MAX_HEAVY of all rows number fewer than MAX_HEAVY and are broadcast.
    Their rows, and rows without a coordinate, already have their answer; they go through
    the shuffle of the others under keys of their own, spread by a row number, that match
    nothing. All other keys hold at most 1/MAX_HEAVY of the rows. ``df`` is read once.
    """
    total = located.agg(F.sum("copies")).first()[0] or 0
    heavy = located.where(F.col("copies") > total / MAX_HEAVY).select(
        x, y, F.col("tract").alias("_heavy_tract")
    )
    done = F.col("_heavy_tract").isNotNull() | F.col(x).isNull() | F.col(y).isNull()
    marked = df.join(F.broadcast(heavy), [x, y], "left").withColumns(
        {
            "_spread": F.when(done, F.monotonically_increasing_id()).otherwise(-1),
            "_key_x": F.when(~done, F.col(x)),
            "_key_y": F.when(~done, F.col(y)),
        }
    )
    keys = located.select(
        F.lit(-1).cast("long").alias("_spread"),
        F.col(x).alias("_key_x"),
        F.col(y).alias("_key_y"),
        F.col("tract").alias("_tract"),
    )
    same = [
        marked["_spread"] == keys["_spread"],
        marked["_key_x"].eqNullSafe(keys["_key_x"]),
        marked["_key_y"].eqNullSafe(keys["_key_y"]),
    ]
    columns = [marked[name] for name in df.columns]
    found = F.coalesce("_heavy_tract", "_tract")
    return marked.join(keys, same, "left").select(*columns, tract_or_unknown(found).alias("tract"))
