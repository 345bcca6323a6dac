"""Connected components of a table of links, by alternating star contractions."""

from pyspark.sql import DataFrame, functions as F

from tractscope.session import write_once


def _state(edges: DataFrame):
    """Number of edges and a sum over them that changes when any edge does."""
    mark = F.xxhash64("node", "root") % F.lit(1 << 40)
    row = edges.agg(F.count("*").alias("n"), F.sum(mark).alias("s")).first()
    return row.n, row.s


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has a link; root is the component's smallest node.

    Each round turns every node's larger neighbours to its smallest neighbour (large star)
    and then its smaller neighbours likewise (small star), until nothing changes; the number
    of rounds grows with the logarithm of the longest chain. A node with very many links is
    one group of a minimum, combined before the shuffle, and one side of a join whose hot
    partitions adaptive execution splits. Each round's edges are written, so lineage stays
    short and lost executors cost one round at most. Loops and repeated links do no harm;
    rows with a null end are left out.
    """
    high, low = F.greatest(a, b), F.least(a, b)
    edges = links.where(F.col(a) != F.col(b)).select(high.alias("node"), low.alias("root"))
    edges = write_once(edges.distinct(), "component-edges")
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("root"), F.col("node"))).toDF("node", "other")
        least = both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("least"))
        large = (
            both.join(least, "node")
            .where(F.col("other") > F.col("node"))
            .select(F.col("other").alias("node"), F.col("least").alias("root"))
            .distinct()
        )
        large = write_once(large, "component-large")
        lowest = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(lowest, "node")
        edges = (
            small.select("node", F.col("least").alias("root"))
            .union(small.select("root", "least"))
            .where(F.col("node") != F.col("root"))
            .distinct()
        )
        edges = write_once(edges, "component-edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges
