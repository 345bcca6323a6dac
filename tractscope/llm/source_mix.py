"""Mixing sources to target weights: capped water-filling and seeded repetition."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tractscope.llm.tables import join_small, numbered, seeded_hash
from tractscope.session import write_once

WORD = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 3
WEIGHT_CYCLE = 3
RANGE_BITS, HASH_BITS = 8, 31
# Rows alike are taken by blocks of so many bits of row numbers, and one by one in one block.
ROW_BITS = 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame) -> DataFrame:
    """Weights 1, 2, 3, 1, ... to the sources by code point, the null source last."""
    order = sources.withColumn("is_null_source", F.col("source").isNull())
    ranked = numbered(order, ["is_null_source", "source"], "source_rank")
    weight = (F.col("source_rank") % WEIGHT_CYCLE + 1).cast("double")
    return ranked.withColumn("weight", weight).drop("is_null_source", "source_rank")


def water_fill(sources: DataFrame, total: float, epochs: float) -> DataFrame:
    """``sources`` (source_size, weight) with ``target``, targets summing to ``total``.

    Each round shares what the clamped sources leave by weight among the others and clamps
    those that would then pass ``epochs`` times their size. The share per weight only grows,
    so a clamped source stays clamped and the rounds end, at the latest when all are. Each
    round is one aggregate over the sources; the driver sees two sums. If even all caps
    together are below ``total``, every target is its cap.
    """
    cap = F.col("source_size") * F.lit(float(epochs))
    share, clamped_before = 0.0, -1
    while True:
        clamped = cap <= F.col("weight") * F.lit(share)
        sums = sources.agg(
            F.sum(F.when(clamped, cap).otherwise(0.0)).alias("full"),
            F.sum(F.when(clamped, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.count(F.when(clamped, 1)).alias("clamped"),
        ).first()
        if not sums["open"] or sums["clamped"] == clamped_before:
            break
        share, clamped_before = (total - sums["full"]) / sums["open"], sums["clamped"]
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(share)))


@dataclass
class MixPlan:
    """What decides how often a row is taken: a row for each source, and few rows by number.

    ``sources`` has source, source_size, target, ``whole`` (how often every row is taken),
    ``last_range`` (rows of earlier hash ranges are taken once more); ``more`` the numbers of
    the other rows that are taken once more.
    """

    sources: DataFrame
    more: DataFrame
    seed: int


def plan_mix(
    rows: DataFrame, seed: int = 0, epochs: float = MAX_EPOCHS, weights: DataFrame | None = None
) -> MixPlan:
    """Plan a mix of ``rows`` (id, source, size, row; row is unique). ``rows`` is read often,
    so it must be cheap: narrow and written.

    Every row of a source is taken target div source_size times, and a part of each source
    once more: its rows in the order of a seeded hash of the id, as long as the whole fits
    what is still open, then the one other row whose size comes nearest to the rest, if that
    brings the source nearer to its target. For this, sizes are summed by hash ranges, 256
    of them and then 256 inside the one in which the open part ends. In that inner range they
    are summed by hash, id and size, so rows that share an id, or have none, count as one row
    for each size; among rows alike in all three, those with the smallest numbers are taken,
    summed by blocks of row numbers. So no source, and no id, is gathered or sorted as one
    group.
    """
    rows = rows.withColumn("at", seeded_hash(F.col("id"), seed))
    sizes = write_once(
        rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources"
    )
    if weights is None:
        weighted = cyclic_weights(sizes)
    else:
        named = weights.select(F.col("source").alias("of"), F.col("weight").cast("double"))
        weighted = sizes.join(named, sizes["source"].eqNullSafe(F.col("of")), "left")
        weighted = weighted.drop("of").fillna({"weight": 0.0})
    total = float(sizes.agg(F.sum("source_size")).first()[0] or 0)
    filled = water_fill(write_once(weighted, "mix-weights"), total, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    filled = filled.withColumn("whole", F.coalesce(whole, F.lit(0)).cast("long"))
    opened = F.col("target") - F.col("whole") * F.col("source_size")
    plan = write_once(
        filled.withColumn("open", opened).withColumn("source_no", F.monotonically_increasing_id()),
        "mix-plan",
    )

    planned = _with_source(rows, plan.select("source", "source_no", "open"))
    start = plan.select("source_no", "open", F.lit(0).alias("start"))
    outer = _range_of_end(planned, F.shiftright("at", HASH_BITS - RANGE_BITS), start, "outer")
    inside = join_small(planned.drop("open"), outer.select("source_no", "outer"), "source_no")
    inside = inside.where(F.shiftright("at", HASH_BITS - RANGE_BITS) == F.col("outer"))
    number = F.shiftright("at", HASH_BITS - 2 * RANGE_BITS)
    last = _range_of_end(inside, number, outer.drop("outer"), "last_range")
    placed = join_small(planned.drop("open"), last, "source_no", "left").withColumn(
        "open", F.coalesce("open", F.lit(0.0))
    )
    inner = placed.where((number == F.col("last_range")) & (F.col("size") > 0))
    edge = write_once(_up_to_open(write_once(inner, "mix-inner")), "mix-edge")
    below = write_once(
        placed.where(number < F.col("last_range"))
        .groupBy("source_no")
        .agg(F.sum("size").alias("below")),
        "mix-below",
    )
    taken = (
        below.unionByName(edge.select("source_no", F.col("size").alias("below")))
        .groupBy("source_no")
        .agg(F.sum("below").alias("taken"))
    )
    rests = last.join(taken, "source_no", "left").select(
        "source_no", (F.col("open") - F.coalesce("taken", F.lit(0))).alias("rest")
    )
    rests = write_once(rests, "mix-rests")
    candidates = placed.where(number >= F.col("last_range")).drop("open", "start")
    candidates = join_small(candidates, rests, "source_no")
    candidates = join_small(candidates, edge.select("row"), "row", "left_anti")
    miss = F.abs(F.col("size") - F.col("rest"))
    fillers = (
        candidates.where((F.col("size") > 0) & (miss < F.col("rest")))
        .groupBy("source_no")
        .agg(F.min(F.struct(miss.alias("miss"), "at", "id", "size", "row"))["row"].alias("row"))
    )
    more = write_once(edge.select("row").union(fillers.select("row")), "mix-more")
    sources = plan.join(last.select("source_no", "last_range"), "source_no", "left")
    sources = write_once(
        sources.select("source", "source_size", "target", "whole", "last_range"), "mix-decided"
    )
    return MixPlan(sources, more, seed)


def _with_source(rows, table):
    """Rows with the columns of their source, the null source included."""
    table = table.withColumnRenamed("source", "source_of_plan")
    joined = join_small(rows, table, F.col("source").eqNullSafe(F.col("source_of_plan")))
    return joined.drop("source_of_plan")


def _range_of_end(rows, number, starts, name):
    """(source_no, ``name``, open, start): the hash range in which a source's open part ends,
    and the sum of the sizes before it. ``starts`` has the sum before the first range."""
    up_to = Window.partitionBy("source_no").orderBy(name)
    ranges = rows.groupBy("source_no", number.alias(name)).agg(F.sum("size").alias("inside"))
    ends = ranges.withColumn("upto", F.sum("inside").over(up_to)).join(starts, "source_no")
    before = (F.col("start") + F.col("upto") - F.col("inside")).alias("start")
    first = F.min(F.struct(name, "open", before)).alias("first")
    found = (
        ends.where(F.col("start") + F.col("upto") > F.col("open"))
        .groupBy("source_no")
        .agg(first)
        .select("source_no", f"first.{name}", "first.open", "first.start")
    )
    return write_once(found, f"mix-{name}")


def _up_to_open(rows):
    """(source_no, row, size) of the ``rows`` of each source that, in the order of at, id, size
    and row, end within its open part."""
    some, before = F.col("size") * F.col("n"), F.col("end") - F.col("size") * F.col("n")
    order = Window.partitionBy("source_no").orderBy("at", "id", "size")
    kinds = rows.groupBy("source_no", "open", "start", "at", "id", "size").agg(F.count("*").alias("n"))
    kinds = kinds.withColumn("end", F.col("start") + F.sum(some).over(order))
    still = F.floor((F.col("open") - before) / F.col("size")).alias("still")
    cut = (
        kinds.where(F.col("end") > F.col("open"))
        .groupBy("source_no")
        .agg(F.min(F.struct(F.struct("at", "id", "size").alias("kind"), still)).alias("cut"))
        .select("source_no", "cut.kind", "cut.still")
    )
    rows = join_small(rows, write_once(cut, "mix-cut"), "source_no", "left")
    kind = F.struct("at", "id", "size")
    ahead = rows.where(F.col("kind").isNull() | (kind < F.col("kind")))

    alike = rows.where(kind.eqNullSafe(F.col("kind"))).withColumn(
        "block", F.shiftright("row", ROW_BITS)
    )
    blocks = alike.groupBy("source_no", "still", "block").agg(F.count("*").alias("n"))
    up_to = Window.partitionBy("source_no").orderBy("block")
    blocks = blocks.withColumn("end", F.sum("n").over(up_to)).where(F.col("end") > F.col("still"))
    left = (F.col("still") - F.col("end") + F.col("n")).alias("left")
    last = blocks.groupBy("source_no").agg(F.min(F.struct("block", left)).alias("last"))
    last = write_once(last.select("source_no", "last.block", "last.left"), "mix-block")
    alike = join_small(alike, last.withColumnRenamed("block", "last_block"), "source_no")
    in_block = Window.partitionBy("source_no").orderBy("row")
    singly = (
        alike.where(F.col("block") == F.col("last_block"))
        .withColumn("place", F.row_number().over(in_block))
        .where(F.col("place") <= F.col("left"))
    )
    taken = [ahead, alike.where(F.col("block") < F.col("last_block")), singly]
    first, *others = (part.select("source_no", "row", "size") for part in taken)
    for part in others:
        first = first.union(part)
    return first


def apply_mix(rows: DataFrame, plan: MixPlan) -> DataFrame:
    """``rows`` (id, source, size, row and any others) with source_size, target, repeats.

    Joins only with the plan's small tables, so wide rows are not shuffled.
    """
    decided = _with_source(rows, plan.sources)
    decided = join_small(decided, plan.more.withColumn("one_more", F.lit(1)), "row", "left")
    number = F.shiftright(seeded_hash(F.col("id"), plan.seed), HASH_BITS - 2 * RANGE_BITS)
    below = F.coalesce(number < F.col("last_range"), F.lit(False)) & (F.col("size") > 0)
    extra = below | F.col("one_more").isNotNull()
    repeats = (F.col("whole") + extra.cast("long")).alias("repeats")
    return decided.select(*rows.columns, "source_size", "target", repeats)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    seed: int = 0,
    epochs: float = MAX_EPOCHS,
    weights: DataFrame | None = None,
) -> DataFrame:
    """How often each document is taken, so that sources come to their target sizes.

    ``docs`` has ``id_col`` (an integer), ``source`` and ``size``, one narrow row for each
    document; it is written once. ``weights`` (source, weight) defaults to 1, 2, 3 repeating
    by code point. Returns ``id_col``, source, size, source_size, target and ``repeats``; see
    ``plan_mix`` for the method.

    Null source: a source of its own, sorted last. Null id: hashed like 0. Null size: 0.
    Documents of size 0 are taken target div source_size times; a source of size 0 has
    target 0 and is not taken. Repeated rows each count; of rows alike in id and size any
    may be taken. Other columns are not looked at. Empty table: empty result.
    """
    slim = docs.select(
        F.col(id_col).alias("id"),
        "source",
        F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    slim = write_once(slim, "mix-sizes")
    mixed = apply_mix(slim, plan_mix(slim, seed, epochs, weights))
    return mixed.drop("row").withColumnRenamed("id", id_col)
