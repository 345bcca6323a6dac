"""Written tables, checked broadcasts, global row numbers and plain-arithmetic hashes."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tractscope.session import write_once

# A side of a join with at most so many narrow rows (about 100 bytes each) is broadcast.
BROADCAST_ROWS = 100_000
# Modulus of the hashes: a prime below 2^31, so no product leaves 63 bits.
PRIME = 2_147_483_647


def join_small(df: DataFrame, small: DataFrame, on, how="inner") -> DataFrame:
    """Join with a table that is expected to be small; ``small`` must be cheap to read.

    It is broadcast only when its counted rows are few. Beyond that the join shuffles
    both sides, and adaptive execution splits the partitions of hot keys.
    """
    if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    return df.join(small, on, how)


def seeded_hash(number: Column, seed: int) -> Column:
    """A number from 0 to 2^31 - 2 out of an integer, by arithmetic any engine can repeat.

    Null counts as 0.
    """
    x = F.pmod(F.coalesce(number.cast("long"), F.lit(0).cast("long")), F.lit(PRIME))
    y = (x * F.lit(48271).cast("long") + F.lit(seed % PRIME)) % PRIME
    z = (y * y + x) % PRIME
    w = (z * F.lit(69621).cast("long") + y) % PRIME
    return (w * w + z) % PRIME


def seeded_hash_sql(number: str, seed: int) -> str:
    """The same as SQL text."""
    x = f"((coalesce({number}, 0) % {PRIME} + {PRIME}) % {PRIME})"
    y = f"(({x} * 48271 + {seed % PRIME}) % {PRIME})"
    z = f"(({y} * {y} + {x}) % {PRIME})"
    w = f"(({z} * 69621 + {y}) % {PRIME})"
    return f"(({w} * {w} + {z}) % {PRIME})"


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with a column ``name``: its row number from 0 in the given order.

    Rows are dealt out by ranges of the order and sorted within each range; a row's number
    is its place in its range plus the rows of the ranges before. The ranges are written
    once, so that both steps see the same ones; the table of ranges has one row for each
    partition. Rows that tie in all of ``order`` get their numbers in any order.
    """
    shift, low = 33, (1 << 33) - 1
    # Names that no column of the caller's is likely to have.
    at, part, start = f"_numbered_{name}_at", f"_numbered_{name}_part", f"_numbered_{name}_start"
    sort = [F.col(c).asc_nulls_last() for c in order]
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(spread, *sort).sortWithinPartitions(*sort)
    written = write_once(ranged.withColumn(at, F.monotonically_increasing_id()), name)
    placed = written.withColumn(part, F.shiftright(at, shift))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy(part).agg(F.count("*").alias("rows_in_range"))
    starts = ranges.select(
        part, F.coalesce(F.sum("rows_in_range").over(before), F.lit(0)).alias(start)
    )
    number = F.col(start) + F.col(at).bitwiseAND(F.lit(low))
    return (
        placed.join(F.broadcast(starts), part)
        .withColumn(name, number)
        .drop(at, part, start)
    )
