"""Exact top-k search by exhaustive term-at-a-time accumulation.

Candidates are cut into blocks. Each component number (term) of a block has its postings: the
rows in which the component is not zero, with their weights. A query row walks its own
non-zero components and scatters weight times posting into a dense array of scores, one for
each row of the block. The best k of each block are selected by partition and merged.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tractscope.llm.tables import numbered
from tractscope.session import write_once

# A block has at most so many rows and, with more than one row, components.
BLOCK_ROWS, BLOCK_WEIGHTS = 2048, 1 << 18
# Query rows scored at once: bounds the array of scores to 64 * 2048 numbers.
CHUNK_ROWS = 64
# Query blocks up to this many bytes are broadcast; more are dealt out with the candidates.
BROADCAST_BYTES = 16 << 20

_PACKED = StructType(
    [
        StructField("ids", BinaryType()),
        StructField("lengths", BinaryType()),
        StructField("weights", BinaryType()),
    ]
)
_FOUND = StructType([StructField(name, LongType()) for name in ("query_id", "vec_id", "score")])


def quantized(vectors: DataFrame, id_col: str, vector_col: str, factor: int = 256) -> DataFrame:
    """(vec_id, weights): each component x as floor(factor * x), x taken as double.

    Rows with a null id and vectors that are null or hold a null or a component that is not
    finite are left out. An empty vector stays and scores 0 everywhere.
    """
    weights = F.transform(
        F.col(vector_col), lambda x: F.floor(x.cast("double") * factor).cast("long")
    )
    sound = F.forall(
        F.col(vector_col),
        lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)),
    )
    return vectors.where(
        F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & sound
    ).select(F.col(id_col).cast("long").alias("vec_id"), weights.alias("weights"))


def packed(rows: DataFrame) -> DataFrame:
    """(vec_id, weights) rows as blocks of arrays, each block sorted by id."""

    def run(batches):
        for batch in batches:
            ids = np.asarray(batch.column(0), np.int64)
            lists = batch.column(1)
            lengths = np.asarray(lists.value_lengths(), np.int64)
            weights = np.asarray(lists.flatten(), np.int64)
            starts = np.r_[0, np.cumsum(lengths)]
            at = 0
            while at < len(ids):
                to = int(np.searchsorted(starts, starts[at] + BLOCK_WEIGHTS, "right")) - 1
                to = min(max(to, at + 1), at + BLOCK_ROWS, len(ids))
                order = at + np.argsort(ids[at:to], kind="stable")
                parts = [weights[starts[i] : starts[i + 1]] for i in order]
                columns = (ids[order], lengths[order], np.concatenate(parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([column.tobytes()], pa.binary()) for column in columns],
                    names=_PACKED.names,
                )
                at = to

    return rows.mapInArrow(run, _PACKED)


class Block:
    """Rows with ids and weights, unpacked into (row, term, weight) without zeros."""

    def __init__(self, ids, lengths, weights):
        self.ids = np.frombuffer(ids, np.int64)
        lengths = np.frombuffer(lengths, np.int64)
        weights = np.frombuffer(weights, np.int64)
        rows = np.repeat(np.arange(len(lengths)), lengths)
        terms = np.arange(len(weights)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        used = weights != 0
        self.rows, self.terms, self.weights = rows[used], terms[used], weights[used]

    def postings(self):
        """term -> (rows, weights)."""
        order = np.argsort(self.terms, kind="stable")
        terms, first = np.unique(self.terms[order], return_index=True)
        rows = np.split(self.rows[order], first[1:])
        weights = np.split(self.weights[order], first[1:])
        return {int(t): (r, w) for t, r, w in zip(terms, rows, weights, strict=True)}


def accumulate(queries: Block, at: int, to: int, postings, n_rows: int):
    """Scores of the query rows at..to against every row of a block, term by term."""
    scores = np.zeros((to - at, n_rows), np.int64)
    low, high = np.searchsorted(queries.rows, (at, to))
    terms = queries.terms[low:high]
    order = np.argsort(terms, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(terms[order])) + 1):
        if len(part) == 0 or int(terms[part[0]]) not in postings:
            continue
        rows, weights = postings[int(terms[part[0]])]
        mine = queries.rows[low:high][part] - at
        product = np.multiply.outer(queries.weights[low:high][part], weights)
        if len(rows) == n_rows and len(mine) == to - at:
            scores += product
        elif len(rows) == n_rows:
            scores[mine] += product
        else:
            scores[np.ix_(mine, rows)] += product
    return scores


def best(scores, own, k):
    """(query row, candidate row) of the k best of each row: higher scores, then lower rows.

    ``own`` marks pairs that do not count.
    """
    n = scores.shape[1]
    k = min(k, n)
    limit = (1 << 62) // max(n, 1)
    if scores.size and max(abs(int(scores.max())), abs(int(scores.min()))) < limit:
        keys = scores * n + np.arange(n - 1, -1, -1)
        keys[own] = np.iinfo(np.int64).min
        chosen = np.argpartition(keys, n - k, axis=1)[:, n - k :]
    else:
        position = np.broadcast_to(np.arange(n), scores.shape)
        chosen = np.lexsort((position, ~scores, own), axis=1)[:, :k]
    rows = np.repeat(np.arange(len(scores)), k)
    columns = chosen.ravel()
    valid = ~own[rows, columns]
    return rows[valid], columns[valid]


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    factor: int = 256,
) -> DataFrame:
    """The k rows of ``vectors`` with the highest integer inner product with each query.

    Returns query_id, rank (from 1), vec_id and score; ties go to the smaller vec_id; fewer
    than k candidates give fewer rows. A query's own row does not count, and a row is a
    query's own if it has its id. Components beyond the shorter of two vectors count as 0.
    Repeated rows are candidates each; of queries that share an id the one with the
    smallest vector is asked. Scores are 64-bit and so must the sums be.

    Every block of candidates meets every block of queries. Few query blocks, by their
    measured bytes, are broadcast; otherwise both sides are dealt out by query block and a
    share of the candidate blocks, so no task holds more than one pair of blocks at a time.
    """
    spark = vectors.sparkSession
    asked = quantized(queries, id_col, vector_col, factor).groupBy("vec_id").agg(
        F.min("weights").alias("weights")
    )
    # Few tasks pack the queries, so that their blocks are full.
    asked = write_once(asked, "queries")
    sums = asked.agg(F.count("*").alias("n"), F.sum(F.size("weights")).alias("weights")).first()
    full = max(sums.n // BLOCK_ROWS, (sums.weights or 0) // BLOCK_WEIGHTS) + 1
    names = {name: f"query_{name}" for name in _PACKED.names}
    blocks = packed(asked.coalesce(full)).withColumnsRenamed(names)
    blocks = blocks.withColumn("block_key", F.crc32("query_ids"))
    numbered_blocks = numbered(blocks, ["block_key"], "query_block").drop("block_key")
    query_blocks = write_once(numbered_blocks, "query-blocks")
    size = F.octet_length("query_weights") + F.octet_length("query_ids") * 2
    facts = query_blocks.agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).first()
    candidates = packed(quantized(vectors, id_col, vector_col, factor))
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(facts.n, 1) - 1).cast("long")))
    pairs = candidates.select("*", numbers.alias("query_block"))
    if (facts.bytes or 0) <= BROADCAST_BYTES:
        pairs = pairs.join(F.broadcast(query_blocks), "query_block")
    else:
        shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
        share = (F.crc32("ids") % shares).alias("share")
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long")))
        pairs = pairs.select("*", share).join(
            query_blocks.select("*", copies.alias("share")), ["query_block", "share"]
        )

    def run(batches):
        held = None
        for batch in batches:
            for pair in batch.to_pylist():
                # A block of candidates is followed by itself, once for each block of queries.
                packed_block = tuple(pair[name] for name in _PACKED.names)
                if packed_block != held:
                    held, block = packed_block, Block(*packed_block)
                    postings = block.postings()
                asked = Block(*(pair[names[name]] for name in _PACKED.names))
                for at in range(0, len(asked.ids), CHUNK_ROWS):
                    to = min(at + CHUNK_ROWS, len(asked.ids))
                    scores = accumulate(asked, at, to, postings, len(block.ids))
                    own = block.ids[None, :] == asked.ids[at:to, None]
                    rows, columns = best(scores, own, k)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(asked.ids[at + rows]),
                            pa.array(block.ids[columns]),
                            pa.array(scores[rows, columns]),
                        ],
                        names=_FOUND.names,
                    )

    packed_names = [*_PACKED.names, *names.values()]
    found = pairs.select(*packed_names).mapInArrow(run, _FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
