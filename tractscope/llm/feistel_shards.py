"""Reproducible shuffle into shards by a permutation of the global row numbers.

A row's place in the shuffled order is a function of its row number, the number of rows
and a seed alone, so any reader can compute where row i went (``place``), or which row
lies at a place (``row_at``), without a table.
"""

from math import isqrt

from pyspark.sql import Column, DataFrame, functions as F

from tractscope.llm.tables import PRIME, numbered

ROUNDS = 6
# A second prime: taking remainders by two primes in turn keeps the rounds from being linear.
PRIME_2 = 2_147_483_629
# Walks of more steps are followed in a loop of at most so many; see ``permuted``.
MAX_WALK = 64


def domain(rows: int) -> tuple[int, int]:
    """Sides a, b of the smallest near-square grid with a * b >= rows, a >= b."""
    a = max(1, isqrt(rows))
    a += a * a < rows
    return a, max(1, -(-rows // a))


def round_keys(seed: int) -> list[tuple[int, int]]:
    """Multiplier and offset of each round."""
    keys = []
    for r in range(1, ROUNDS + 1):
        x = (seed * 1_000_003 + r * 7_368_787) % PRIME
        x = (x * x + r) % PRIME
        keys.append((x | 1, (x * 48271 + r) % PRIME))
    return keys


def _mix(half, key):
    """Round function; works on Python numbers and on columns."""
    return ((half % PRIME * key[0] + key[1]) % PRIME * key[1] + key[0]) % PRIME_2


def _rounds(left, right, a, b, keys):
    for r, key in enumerate(keys):
        if r % 2 == 0:
            left = (left + _mix(right, key)) % a
        else:
            right = (right + _mix(left, key)) % b
    return left, right


def place(row: int, rows: int, seed: int = 0) -> int:
    """Where the row goes: its place from 0 to rows - 1 in the shuffled order."""
    a, b = domain(rows)
    while True:
        left, right = _rounds(row // b, row % b, a, b, round_keys(seed))
        row = left * b + right
        if row < rows:
            return row


def row_at(at: int, rows: int, seed: int = 0) -> int:
    """The row that ``place`` sends to ``at``."""
    a, b = domain(rows)
    while True:
        left, right = at // b, at % b
        for r, key in reversed(list(enumerate(round_keys(seed)))):
            if r % 2 == 0:
                left = (left - _mix(right, key)) % a
            else:
                right = (right - _mix(left, key)) % b
        at = left * b + right
        if at < rows:
            return at


def permuted(row: Column, rows: int, seed: int = 0) -> Column:
    """``place`` as a column.

    The halves are numbers below a and b and are changed by addition, so the rounds permute
    a grid of a * b cells, of which fewer than a are beyond the rows. A row that lands there
    walks on. Each step leads outside again with a chance of about one in the square root of
    the number of rows, and the walk is allowed as many steps as there are cells outside, 64
    at most; should a walk ever be longer, the query fails and takes no wrong place.
    """
    a, b = domain(rows)
    keys = round_keys(seed)

    rounds = F.array(
        *(
            F.struct(
                F.lit(r % 2 == 0).alias("on_left"),
                F.lit(key[0]).cast("long").alias("m"),
                F.lit(key[1]).cast("long").alias("c"),
            )
            for r, key in enumerate(keys)
        )
    )

    def one_round(halves, key):
        mix_key = key["m"], key["c"]
        left = (halves["left"] + _mix(halves["right"], mix_key)) % a
        right = (halves["right"] + _mix(halves["left"], mix_key)) % b
        return F.struct(
            F.when(key["on_left"], left).otherwise(halves["left"]).alias("left"),
            F.when(key["on_left"], halves["right"]).otherwise(right).alias("right"),
        )

    def step(cell):
        halves = F.struct(
            F.call_function("div", cell, F.lit(b)).alias("left"),
            (cell % F.lit(b).cast("long")).alias("right"),
        )
        return F.aggregate(
            rounds, halves, one_round, lambda h: h["left"] * F.lit(b).cast("long") + h["right"]
        )

    first = step(row.cast("long"))
    if a * b == rows:
        return first
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(min(a * b - rows, MAX_WALK))),
        first,
        lambda cell, _: F.when(cell < rows, cell).otherwise(step(cell)),
    )
    checked = F.when(walked < rows, walked).otherwise(
        F.raise_error(F.lit("cycle walk too long")).cast("long")
    )
    return F.when(first < rows, first).otherwise(checked)


def assign_shards(
    df: DataFrame, order: list[str], shards: int = 8, seed: int = 0, row_name: str = "row_number"
) -> DataFrame:
    """``df`` with ``row_name`` (global row number in ``order``), ``shard`` and ``slot``.

    Place p of the shuffled order is slot p div shards of shard p mod shards: shards differ
    by one row at most and their slots have no gaps. Rows with nulls are placed like others
    (nulls sort last); rows that tie in ``order`` are told apart arbitrarily, so name enough
    columns; an empty table stays empty. Columns named shard, slot or ``row_name`` are
    replaced.
    """
    kept = df.drop("shard", "slot", row_name)
    rows = kept.count()
    at = permuted(F.col(row_name), max(rows, 1), seed)
    return (
        numbered(kept, order, row_name)
        .withColumn("_shuffled_place", at)
        .withColumn("shard", (F.col("_shuffled_place") % shards).cast("int"))
        .withColumn("slot", F.call_function("div", "_shuffled_place", F.lit(shards)))
        .drop("_shuffled_place")
    )
