"""Held-out rows and bounded samples of labelled documents."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tractscope.llm.tables import PRIME, seeded_hash
from tractscope.session import write_once

FOLDS, HELD_OUT = 4, 2


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text leaves the held-out remainder. A null id has an empty
    text."""
    text = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % FOLDS == HELD_OUT


def sample_ids(
    rows: DataFrame, id_col: str, label_col: str, per_label: int, seed: int, total: int = 100_000
):
    """(id_col, label_col) of at most ``per_label`` rows of each label, by a seeded hash, and of
    at most ``total`` rows; more labels than that raise an error.

    The ids of a label are estimated first, each task sending a sketch of them. Only ids whose
    hash lies below a bound that lets about twice as many through as are wanted are ranked, so
    a label's ranking has much the same few rows however many the label has. Rows with a null
    id or label are not sampled; a repeated id counts once for each label.
    """
    narrow = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    narrow = narrow.select(id_col, label_col)
    sizes = narrow.groupBy(label_col).agg(F.approx_count_distinct(id_col).alias("sample_size"))
    sizes = write_once(sizes, "label-sizes")
    labels = sizes.limit(total + 1).count()
    if labels > total:
        raise ValueError(f"more than {total} labels")
    per_label = min(per_label, total // max(labels, 1))
    spot = seeded_hash(F.col(id_col), seed)
    share = F.lit(2.0 * per_label + 64) / F.col("sample_size")
    # At most ``total`` rows are broadcast.
    low = narrow.join(F.broadcast(sizes), label_col).where(spot < share * PRIME).drop("sample_size")
    order = Window.partitionBy(label_col).orderBy(spot, id_col)
    return (
        low.distinct()
        .withColumn("sample_rank", F.row_number().over(order))
        .where(F.col("sample_rank") <= per_label)
        .select(id_col, label_col)
    )
