"""Grid index over tract boundaries, for a distributed point-in-polygon join.

A boundary table has one row per tract: ``tract`` and ``rings``, an array of rings,
each an array of ``struct<x,y>``. Outer rings, further parts and holes are all just
rings: a point is inside when it is enclosed an odd number of times.

The grid has coarse cells, and a coarse cell in which many sides meet is cut into
4, 16, ... finer ones. Sides are sent to the cells they touch; the cells between two
border cells of a row are filled by the parity of the sides farther east, without
looking at geometry. So the work follows the length of the borders, and the area
counts only in coarse cells.

An index entry of a border cell keeps the sides near the cell, the parity of all
other sides east of it at its lower end, and the heights at which that parity
changes. These heights need no other side: two sides meet at each corner, so the
parity of the others changes just where one of the cell's own sides ends east of it.
The answer is exactly that of all sides.
"""

import warnings
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tractscope.session import shared_folder, write_once

# Degrees of a coarse cell.
DEFAULT_CELL = 0.04

# A coarse cell with more sides than this is cut, so that about MEAN_SIDES of them fall
# into each finer cell, but not into more than 4 ** MAX_LEVEL.
MAX_SIDES, MEAN_SIDES, MAX_LEVEL = 16, 8, 6

# The index is broadcast only when its measured size stays below this.
BROADCAST_BYTES = 128 * 1024 * 1024
_ENTRY_BYTES = 200
_EDGE_BYTES = 48
_LEVEL_BYTES = 40

# Cells are treated as this much larger, so a point whose cell number is off by one
# rounding step still finds every edge it needs.
_PAD = 1e-7

# Bits of a cell number in a join key: level, column and row make one long.
_NUMBER_BITS = 29
_HALF = 1 << (_NUMBER_BITS - 1)


@dataclass(frozen=True)
class TractIndex:
    """``cells`` (cell, sole_tract, candidates), ``levels`` (coarse, level) of the cut coarse
    cells, and the number of boundary rows that were rejected."""

    cells: DataFrame
    levels: DataFrame
    cell_size: float
    fits_broadcast: bool
    rejected: int = 0


def ring_edges(rings: Column) -> Column:
    """All sides of all rings, each from its lower to its upper end.

    The order makes a side shared by two tracts one and the same, so a point next
    to it is counted in exactly one of them.
    """

    def side(p, q):
        flip = p.y > q.y
        low = F.when(flip, q).otherwise(p)
        high = F.when(flip, p).otherwise(q)
        return F.struct(
            low.y.alias("low"),
            high.y.alias("high"),
            low.x.alias("x"),
            high.x.alias("x_high"),
            F.coalesce(F.try_divide(high.x - low.x, high.y - low.y), F.lit(0.0)).alias("slope"),
        )

    def sides(ring):
        following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(ring, following, side)

    return F.flatten(F.transform(rings, sides))


def is_boundary(size: float) -> Column:
    """Whether a row can be indexed: a tract, and rings of finite corners on the grid.

    A missing or infinite corner makes the whole tract unusable: the sides next to it are
    unknown, and even-odd counting with the others would be wrong elsewhere, too.
    """
    reach = float(_HALF >> (MAX_LEVEL + 1)) * size

    def sound(corner):
        return (F.abs(corner.x) < reach) & (F.abs(corner.y) < reach)

    corners = F.flatten("rings")
    good = F.forall(corners, lambda corner: F.coalesce(sound(corner), F.lit(False)))
    return F.coalesce(F.col("tract").isNotNull() & (F.size(corners) > 0) & good, F.lit(False))


def cell_number(degrees: Column, size: float) -> Column:
    """Grid column or row; null where no boundary can be."""
    number = F.floor(degrees / size)
    return F.when(F.abs(number) < F.lit(_HALF >> MAX_LEVEL), number)


def cell_key(level, column: Column, row: Column) -> Column:
    """Level, column and row as one number."""
    wide = F.lit(1 << _NUMBER_BITS).cast("long")
    return (F.lit(level) * wide + column + _HALF) * wide + row + _HALF


def _crossings(edges: Column, x: Column, y: Column) -> Column:
    """Edges met by a ray to the east; lower and left borders belong inside."""

    def crossed(edge):
        return (edge.low <= y) & (y < edge.high) & (x < edge.x + (y - edge.low) * edge.slope)

    return F.size(F.filter(edges, crossed))


def _odd(entry: Column, x: Column, y: Column) -> Column:
    """Whether an odd number of all sides lies east of a point of the entry's cell."""
    turns_below = F.size(F.filter(entry.turns, lambda height: height <= y))
    return (entry.odd_below + turns_below + _crossings(entry.edges, x, y)) % 2 == 1


def entry_encloses(entry: Column, x: Column, y: Column) -> Column:
    """Even-odd rule for a point in the cell of an index entry."""
    return entry.fills | _odd(entry, x, y)


def _unpaired(heights: Column) -> Column:
    """Values that occur an odd number of times, in order."""

    def add(kept, height):
        count = F.size(kept)
        repeats = F.get(kept, count - 1) == height
        return F.when(repeats, F.slice(kept, F.lit(1), count - 1)).otherwise(
            F.concat(kept, F.array(height))
        )

    return F.aggregate(F.array_sort(heights), F.array().cast("array<double>"), add)


def _turns(edges: Column, middle: Column, floor: Column, ceiling: Column) -> Column:
    """Heights in the cell's rows at which the parity of the other sides to the east changes.

    A corner at which one of the cell's sides meets another of them counts twice, and a
    corner near the cell is one of those; what is left are corners where a side goes on
    outside. West of the cell that changes nothing.
    """
    ends = F.concat(
        F.transform(edges, lambda e: F.struct(e.x.alias("x"), e.low.alias("y"))),
        F.transform(edges, lambda e: F.struct(e.x_high.alias("x"), e.high.alias("y"))),
    )
    east = F.filter(ends, lambda p: (p.x >= middle) & (p.y > floor) & (p.y <= ceiling))
    return _unpaired(F.transform(east, lambda p: p.y))


def _reaches_cell(edge: Column, left, bottom, size) -> Column:
    """The edge meets the padded cell: boxes overlap and the cell lies on both sides."""
    half = size / 2 + _PAD
    mid_x, mid_y = left + size / 2, bottom + size / 2
    dx, dy = edge.x_high - edge.x, edge.high - edge.low
    offset = F.abs(dx * (mid_y - edge.low) - dy * (mid_x - edge.x))
    return (
        (F.least(edge.x, edge.x_high) <= mid_x + half)
        & (F.greatest(edge.x, edge.x_high) >= mid_x - half)
        & (edge.low <= mid_y + half)
        & (edge.high >= mid_y - half)
        & (offset <= (F.abs(dx) + dy) * half)
    )


def _numbers(low: Column, high: Column, size: float) -> Column:
    return F.sequence(cell_number(low - _PAD, size), cell_number(high + _PAD, size))


def _sides_in_cells(edges: DataFrame, size: float) -> DataFrame:
    """One row per tract and coarse cell that a side of it touches, with these sides.

    A side goes to the rows it spans, and in each row to the columns it passes there.
    """
    bottom = F.col("cell_y") * F.lit(size)
    slope, low, x = F.col("edge.slope"), F.col("edge.low"), F.col("edge.x")
    enters = F.greatest(low, bottom - _PAD)
    leaves = F.least(F.col("edge.high"), bottom + (size + _PAD))
    level = low == F.col("edge.high")
    at_enter = x + (enters - low) * slope
    at_leave = F.when(level, F.col("edge.x_high")).otherwise(x + (leaves - low) * slope)
    columns = _numbers(F.least(at_enter, at_leave), F.greatest(at_enter, at_leave), size)
    return (
        edges.withColumn("cell_y", F.explode(_numbers(low, F.col("edge.high"), size)))
        .withColumn("cell_x", F.explode(columns))
        .groupBy("tract", "cell_y", "cell_x")
        .agg(F.collect_list("edge").alias("edges"))
    )


def _row_lines(edges: DataFrame, size: float) -> DataFrame:
    """Where the sides of a tract cross the lower end of each row of cells."""
    low, high = F.col("edge.low"), F.col("edge.high")
    line = F.col("cell_y") * F.lit(size) - _PAD
    rows = F.sequence(cell_number(low, size), cell_number(high, size) + 1)
    return (
        edges.withColumn("cell_y", F.explode(rows))
        .where((low <= line) & (line < high))
        .withColumn("at", F.col("edge.x") + (line - low) * F.col("edge.slope"))
        .groupBy("tract", "cell_y")
        .agg(F.collect_list("at").alias("line"))
    )


def _entry(tract, fills, odd_below, turns, edges) -> list[Column]:
    return [
        F.col(tract).alias("tract"),
        F.lit(fills).alias("fills"),
        odd_below.cast("int").alias("odd_below"),
        turns.alias("turns"),
        edges.alias("edges"),
    ]


def _coarse_entries(tracts: DataFrame, size: float) -> DataFrame:
    """Entries of coarse cells: those at a border, and between them those inside."""
    edges = tracts.select("tract", F.explode(ring_edges(F.col("rings"))).alias("edge"))
    floor = F.col("cell_y") * F.lit(size) - _PAD
    right = (F.col("cell_x") + 1) * F.lit(size)
    along = Window.partitionBy("tract", "cell_y").orderBy("cell_x")
    lines = _row_lines(edges, size)
    line = F.coalesce("line", F.array().cast("array<double>"))
    border = (
        _sides_in_cells(edges, size)
        .join(lines, ["tract", "cell_y"], "left")
        .withColumn("odd_right", F.size(F.filter(line, lambda at: right < at)) % 2)
        .withColumn("next_border", F.lead("cell_x").over(along))
        .drop("line")
    )
    own = _crossings(F.col("edges"), right, floor)
    none = F.array().cast("array<double>")
    no_edges = F.filter("edges", lambda _: F.lit(False))
    turns = _turns(
        F.col("edges"),
        (F.col("cell_x") + 0.5) * F.lit(size),
        floor,
        (F.col("cell_y") + 1) * F.lit(size) + _PAD,
    )
    at_border = border.select(
        "cell_x", "cell_y", *_entry("tract", False, (F.col("odd_right") + own) % 2, turns, F.col("edges"))
    )
    between = F.sequence(F.col("cell_x") + 1, F.col("next_border") - 1)
    inside = (
        border.where((F.col("next_border") > F.col("cell_x") + 1) & (F.col("odd_right") == 1))
        .withColumn("cell_x", F.explode(between))
        .select("cell_x", "cell_y", *_entry("tract", True, F.lit(0), none, no_edges))
    )
    return at_border.unionByName(inside)


def _level(sides: Column) -> Column:
    """How often a cell with so many sides is halved each way."""
    wanted = F.ceil(F.log2(sides / F.lit(float(MEAN_SIDES))) / 2)
    return F.when(sides > MAX_SIDES, F.least(wanted, F.lit(MAX_LEVEL))).otherwise(0).cast("int")


def _fine_entries(coarse: DataFrame, size: float) -> DataFrame:
    """Entries of the finer cells of cut coarse cells (cell_x, cell_y, level, entry).

    Sides are narrowed to the finer row first, then to the cell. What is east of a finer
    cell follows from the coarse entry, which answers for every point of its cell.
    """
    parts = F.call_function("shiftleft", F.lit(1), F.col("level"))
    step = F.lit(size) / parts
    bottom = F.col("cell_y") * F.lit(size) + F.col("sub_y") * step
    left = F.col("cell_x") * F.lit(size) + F.col("sub_x") * step
    floor, ceiling = bottom - _PAD, bottom + step + _PAD
    right, entry = left + step, F.col("entry")
    # Only sides in the row can be met in it; turning heights stay as they are.
    row_entry = F.struct(
        entry.tract.alias("tract"),
        entry.fills.alias("fills"),
        entry.odd_below.alias("odd_below"),
        entry.turns.alias("turns"),
        F.filter(entry.edges, lambda e: (e.low <= ceiling) & (e.high >= floor)).alias("edges"),
    )
    rows = (
        coarse.withColumn("sub_y", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn("entry", row_entry)
        .withColumn("sub_x", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn("edges", F.filter(entry.edges, lambda e: _reaches_cell(e, left, bottom, step)))
    )
    is_border = F.size("edges") > 0
    in_middle = entry_encloses(entry, left + step / 2, bottom + step / 2)
    odd_below = (_odd(entry, right, floor).cast("int") + _crossings(F.col("edges"), right, floor)) % 2
    turns = _turns(F.col("edges"), left + step / 2, floor, ceiling)
    none = F.array().cast("array<double>")
    return rows.where(is_border | in_middle).select(
        cell_key(
            F.col("level"),
            F.col("cell_x") * parts + F.col("sub_x"),
            F.col("cell_y") * parts + F.col("sub_y"),
        ).alias("cell"),
        F.struct(
            entry.tract.alias("tract"),
            (~is_border).alias("fills"),
            F.when(is_border, odd_below).otherwise(0).alias("odd_below"),
            F.when(is_border, turns).otherwise(none).alias("turns"),
            "edges",
        ).alias("entry"),
    )


def build_tract_index(
    tracts: DataFrame, cell_size: float = DEFAULT_CELL, broadcast_bytes: int = BROADCAST_BYTES
) -> TractIndex:
    """Index a boundary table, write it, and measure whether it may be broadcast.

    Work here is over the boundaries only, never over the points. The lists per cell
    hold the tracts that meet there, a matter of geography that does not grow with the
    points. The index is written because every join with it would build it again.
    Rows that are no boundary are left out, counted, and warned of.
    """
    checked = tracts.select("tract", "rings", is_boundary(cell_size).alias("sound"))
    rejected = checked.where(~F.col("sound")).count()
    if rejected:
        warnings.warn(f"{rejected} tracts have no usable boundary and locate no point", stacklevel=2)
    entries = _coarse_entries(checked.where("sound").drop("sound"), cell_size)
    entry = F.struct("tract", "fills", "odd_below", "turns", "edges").alias("entry")
    coarse = (
        entries.select("cell_x", "cell_y", entry)
        .groupBy("cell_x", "cell_y")
        .agg(F.collect_list("entry").alias("entries"), F.sum(F.size("entry.edges")).alias("sides"))
        .withColumn("level", _level(F.col("sides")))
        .withColumn("coarse", cell_key(0, F.col("cell_x"), F.col("cell_y")))
    )
    coarse = write_once(coarse, "tract-coarse")
    whole = coarse.where("level = 0").select(
        F.col("coarse").alias("cell"), F.explode("entries").alias("entry")
    )
    cut = coarse.where("level > 0")
    fine = _fine_entries(
        cut.select("cell_x", "cell_y", "level", F.explode("entries").alias("entry")), cell_size
    )
    slim = F.transform(
        "entry.edges", lambda e: F.struct(*(e[n].alias(n) for n in ["low", "high", "x", "slope"]))
    )
    row_bytes = F.lit(_ENTRY_BYTES) + (F.size("entry.edges") + F.size("entry.turns")) * _EDGE_BYTES
    candidate = F.struct("entry.tract", "entry.fills", "entry.odd_below", "entry.turns", "edges")
    cells = (
        whole.unionByName(fine)
        .withColumn("edges", slim)
        .groupBy("cell")
        .agg(
            F.when(F.bool_and("entry.fills"), F.min("entry.tract")).alias("sole_tract"),
            F.collect_list(candidate).alias("candidates"),
            F.sum(row_bytes).alias("row_bytes"),
        )
    )
    written = write_once(cells, "tract-index")
    levels = write_once(cut.select("coarse", "level"), "tract-levels")
    return _measured(written, levels, cell_size, broadcast_bytes, rejected)


def _measured(cells, levels, cell_size, broadcast_bytes, rejected) -> TractIndex:
    size = cells.agg(F.sum("row_bytes")).first()[0] or 0
    size += levels.count() * _LEVEL_BYTES
    return TractIndex(
        cells.drop("row_bytes"), levels, cell_size, size <= broadcast_bytes, rejected
    )


def stored_tract_index(
    tracts: DataFrame, cell_size: float = DEFAULT_CELL, broadcast_bytes: int = BROADCAST_BYTES
) -> TractIndex:
    """The index of a boundary table, built once for equal tables and then read again.

    It is found by a fingerprint of the boundaries in the shared folder. Two jobs that build
    it at the same time both write it, and one of them names its own for later ones.
    """
    spark = tracts.sparkSession
    mark = tracts.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("tract", "rings").cast("decimal(38,0)")).alias("sum"),
        F.sum(F.xxhash64("rings", "tract").cast("decimal(38,0)")).alias("sum_2"),
    ).first()
    key = f"{mark.n}-{mark['sum']}-{mark.sum_2}-{cell_size}"
    name = f"{shared_folder(spark)}/tractscope/tract-index-of/{key}"
    try:
        known = spark.read.schema("cells string, levels string, rejected bigint").json(name).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        known = None
    if known is not None:
        cells, levels = spark.read.parquet(known.cells), spark.read.parquet(known.levels)
        return _measured(cells, levels, cell_size, broadcast_bytes, known.rejected)
    index = build_tract_index(tracts, cell_size, broadcast_bytes)
    _name_index(spark, index, name)
    return index


def _name_index(spark: SparkSession, index: TractIndex, name: str) -> None:
    folder = {part: _folder(table) for part, table in (("cells", index.cells), ("levels", index.levels))}
    row = spark.range(1, numPartitions=1).select(
        F.lit(folder["cells"]).alias("cells"),
        F.lit(folder["levels"]).alias("levels"),
        F.lit(index.rejected).cast("long").alias("rejected"),
    )
    row.write.mode("ignore").json(name)


def _folder(written: DataFrame) -> str:
    """Folder of a written table."""
    return written.inputFiles()[0].rpartition("/")[0]
