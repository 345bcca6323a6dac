"""Merkle manifest of a table: a content-addressed store of nodes, and proofs by descent.

Rows are leaves. The leaves of a group ascend by id and are hashed two by two up to the
group's subroot; the subroots, in the order of the groups, are hashed likewise up to the
root. A node whose run holds one child is the hash of that child.

The store holds digest-to-children records, ``SEGMENT`` binary levels in each: the digest of
a segment's top, and below it the children of every node down to at most 256 digests. A
request for a leaf starts at the root and descends by the digits of its rank, one record for
each digit of 8 bits. It collects the children it does not select; the segments of its path,
reversed, are its proof. Requests with the same leading digits descend as one, so a step
moves one row for each wanted record and not one for each leaf. A record lies below at most
256 requests of a step, so no key is hot, whatever the size of a group.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tractscope.llm.tables import join_small, numbered
from tractscope.session import write_once

SEGMENT = 8
WIDTH = 1 << SEGMENT
# Rows of a proof: the side of the sibling, and its digest, null where a run holds one child.
STEP = "struct<left:boolean,digest:string>"


@dataclass
class Manifest:
    """``groups`` (group_key, leaves, subroot, root), ``leaves`` (group_key, rank and the
    columns kept), ``trees``: the tree of the subroots and the trees of the groups."""

    groups: DataFrame
    leaves: DataFrame
    trees: list


@dataclass
class Trees:
    """Trees of many groups: ``tops`` (group_key, leaves, digest) and the records
    (height, digest, levels) of each step, from the leaves up."""

    tops: DataFrame
    records: list[DataFrame]


def digest(*parts) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return digest(*map(field, values))


def group_key(group: Column) -> Column:
    """Text that is never null and sorts as the group does, null first, else by bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def _height(leaves: Column) -> Column:
    """Levels above so many leaves, at most those of a segment."""
    bits = F.when(leaves > 1, F.length(F.bin(leaves - 1))).otherwise(0)
    return F.least(bits, F.lit(SEGMENT)).cast("int")


def _upto(last: Column) -> Column:
    """0 to ``last``; nothing if it is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _above(level: Column) -> Column:
    runs = _upto(F.ceil(F.size(level) / 2).cast("int") - 1)
    return F.transform(
        runs, lambda i: digest(F.get(level, i * 2), F.coalesce(F.get(level, i * 2 + 1), F.lit("")))
    )


def _levels(children: Column, height: Column) -> Column:
    """All levels of a segment, from its children up to its top."""
    return F.aggregate(
        _upto(height - 1),
        F.array(children),
        lambda found, _: F.concat(found, F.array(_above(F.element_at(found, -1)))),
    )


def build_trees(leaves: DataFrame, sizes: DataFrame, label: str) -> Trees:
    """Trees over ``leaves`` (group_key, rank from 0, digest); ``sizes`` (group_key, leaves).

    Each step hashes 256 nodes at most in one row. Groups that are reduced to one node take
    no part in further steps.
    """
    most = sizes.agg(F.max("leaves")).first()[0] or 1
    records, tops, nodes, rest = [], [], leaves, sizes
    while True:
        runs = nodes.groupBy("group_key", F.shiftright("rank", SEGMENT).alias("rank")).agg(
            F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("nodes")
        )
        # Every node of a step has as many levels above it as any other of its group.
        left = rest.select("group_key", F.col("leaves").alias("wide"))
        runs = join_small(runs, left, "group_key").select(
            "group_key", "rank", "wide", _height(F.col("wide")).alias("height"), "nodes.digest"
        )
        runs = runs.withColumn("levels", _levels(F.col("digest"), F.col("height")))
        runs = runs.withColumn("digest", F.get(F.element_at("levels", -1), F.lit(0)))
        runs = write_once(runs, f"{label}-nodes-{len(records)}")
        records.append(runs.select("height", "digest", "levels").dropDuplicates(["height", "digest"]))
        tops.append(runs.where(F.col("wide") <= WIDTH).select("group_key", "digest"))
        if most <= WIDTH:
            break
        most = -(-most // WIDTH)
        nodes = runs.where(F.col("wide") > WIDTH).select("group_key", "rank", "digest")
        rest = rest.where(F.col("leaves") > WIDTH).select(
            "group_key", F.ceil(F.col("leaves") / WIDTH).cast("long").alias("leaves")
        )
    tops = write_once(reduce(DataFrame.union, tops), f"{label}-tops")
    return Trees(join_small(sizes, tops, "group_key"), records)


def descend(trees: Trees, wanted: DataFrame, paths: DataFrame) -> DataFrame:
    """Records that hold the wanted leaves: (group_key, rank >> 8, levels, path).

    ``wanted`` holds (group_key, rank) of the requests; ``paths`` (group_key, path): segments
    collected above the trees' tops, the topmost first. Requests descend from the tops; at
    each step the record of a digest is looked up, and its wanted children go on.
    """
    tops = join_small(trees.tops, paths, "group_key").withColumn("steps", _steps(F.col("leaves")))
    frontier = None
    for step in reversed(range(len(trees.records))):
        starting = tops.where(F.col("steps") == step + 1).select(
            "group_key", F.lit(0).cast("long").alias("rank"), "leaves", "digest", "path"
        )
        frontier = starting if frontier is None else frontier.union(starting)
        nodes = F.ceil(F.col("leaves") / float(WIDTH**step)).cast("long")
        found = frontier.withColumn("height", _height(nodes)).join(
            trees.records[step], ["height", "digest"]
        )
        if step == 0:
            return found.select("group_key", "rank", "levels", "path")
        below = wanted.select(
            "group_key",
            F.shiftright("rank", SEGMENT * step).alias("child"),
            F.shiftright("rank", SEGMENT * (step + 1)).alias("rank"),
        ).distinct()
        digit = F.col("child").bitwiseAND(F.lit(WIDTH - 1)).cast("int")
        frontier = found.join(below, ["group_key", "rank"]).select(
            "group_key",
            F.col("child").alias("rank"),
            "leaves",
            F.get(F.get("levels", F.lit(0)), digit).alias("digest"),
            F.concat("path", F.array(unselected(F.col("levels"), digit))).alias("path"),
        )


def _steps(leaves: Column) -> Column:
    """Segments between so many leaves and their top, one at least."""
    bits = F.when(leaves > 1, F.length(F.bin(leaves - 1))).otherwise(1)
    return F.ceil(bits / SEGMENT).cast("int")


def unselected(levels: Column, digit: Column) -> Column:
    """The children not selected on the way to child ``digit`` of a segment, lowest first."""
    return F.transform(
        _upto(F.size(levels) - 2),
        lambda i: F.struct(
            (F.call_function("shiftright", digit, i) % 2 == 1).alias("left"),
            F.get(F.get(levels, i), F.call_function("shiftright", digit, i).bitwiseXOR(F.lit(1)))
            .alias("digest"),
        ).cast(STEP),
    )


def fold(leaf: Column, path: Column) -> Column:
    """Root that follows from a leaf and its siblings."""
    return F.aggregate(
        path,
        leaf,
        lambda node, step: F.when(step["digest"].isNull(), digest(node))
        .when(step["left"], digest(step["digest"], node))
        .otherwise(digest(node, step["digest"])),
    )


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: s["digest"]), ""), 256)


def build(rows: DataFrame, group: Column, order: Column, leaf: Column, keep: dict) -> Manifest:
    """Manifest of ``rows``, whose leaves ascend by ``order`` within ``group``.

    Null orders come last; leaves that tie ascend by digest, so repeated rows are repeated
    leaves and reruns agree. ``keep`` (name to column) stays with the leaves. Digests are
    written before they are ranked; the texts are read once and not shuffled.
    """
    hashed = rows.select(
        group_key(group).alias("group_key"),
        order.alias("leaf_order"),
        leaf.alias("digest"),
        *[column.alias(name) for name, column in keep.items()],
    )
    hashed = write_once(hashed, "manifest-leaves")
    placed = numbered(hashed, ["group_key", "leaf_order", "digest"], "place").drop("rows_in_range")
    sizes = placed.groupBy("group_key").agg(
        F.count("*").alias("leaves"), F.min("place").alias("first_place")
    )
    sizes = write_once(sizes, "manifest-groups")
    starts = sizes.select("group_key", "first_place")
    leaves = join_small(placed, starts, "group_key").select(
        "group_key", (F.col("place") - F.col("first_place")).alias("rank"), "digest", *keep
    )
    trees = build_trees(leaves, sizes.select("group_key", "leaves"), "manifest")
    # The subroots are the leaves of one more tree.
    subroots = numbered(trees.tops.select("group_key", "digest"), ["group_key"], "rank")
    # Written, so that the one key of this tree is a column to join on and not a constant.
    subroots = write_once(
        subroots.select(
            F.lit("").alias("group_key"), "rank", "digest", F.col("group_key").alias("of")
        ),
        "manifest-subroots",
    )
    size = subroots.groupBy("group_key").agg(F.count("*").alias("leaves"))
    above = build_trees(subroots, size, "manifest-root")
    empty = F.array().cast(f"array<array<{STEP}>>")
    found = descend(above, subroots, above.tops.select("group_key", empty.alias("path")))
    root = above.tops.select("group_key", F.col("digest").alias("root"))
    paths = _at_leaves(subroots, found).join(F.broadcast(root), "group_key")
    paths = write_once(paths.select(F.col("of").alias("group_key"), "path", "root"), "manifest-paths")
    groups = join_small(trees.tops, paths, "group_key")
    return Manifest(groups.withColumnRenamed("digest", "subroot"), leaves, [above, trees])


def _at_leaves(requests: DataFrame, found: DataFrame) -> DataFrame:
    """The last digit of every request; its path still has its topmost segment first."""
    records = found.withColumnRenamed("rank", "record")
    digit = F.col("rank").bitwiseAND(F.lit(WIDTH - 1)).cast("int")
    keyed = requests.withColumn("record", F.shiftright("rank", SEGMENT))
    return (
        keyed.join(records, ["group_key", "record"])
        .withColumn("path", F.concat("path", F.array(unselected(F.col("levels"), digit))))
        .drop("levels", "record")
    )


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (group_key, rank and any columns) with subroot, root and ``path``: the
    siblings from the leaf up to the root."""
    paths = manifest.groups.select("group_key", "path")
    found = descend(manifest.trees[1], requests, paths)
    ends = manifest.groups.select("group_key", "subroot", "root")
    reversed_ = F.flatten(F.reverse("path"))
    return join_small(
        _at_leaves(requests, found).withColumn("path", reversed_), ends, "group_key"
    )


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def tampered(doc_id: Column) -> Column:
    """Whether 7 divides crc32 of the decimal id; a null id is left alone."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 7 == 0


def document_proofs(docs: DataFrame) -> DataFrame:
    """Every document's leaf, proof digest and the root folded from it.

    A document for which ``tampered`` holds is folded from its leaf with ``n_chars`` raised by
    1; if that is null nothing is changed and the proof holds. Groups are languages, null
    first. Null ids come last in their group. Columns beyond the five are not hashed. An
    empty table has no rows and no root.
    """
    plain = docs.select(*[docs[c] for c in COLUMNS])
    doc_id, source, lang, n_chars, text = (F.col(c) for c in COLUMNS)
    raised = n_chars.cast("decimal(20,0)") + 1
    changed = F.when(
        tampered(doc_id) & n_chars.isNotNull(), leaf_digest(doc_id, source, lang, raised, text)
    )
    leaf = leaf_digest(doc_id, source, lang, n_chars, text)
    manifest = build(plain, lang, doc_id, leaf, {"doc_id": doc_id, "changed": changed})
    proved = prove(manifest, manifest.leaves)
    folded = fold(F.coalesce("changed", "digest"), F.col("path"))
    rows = proved.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
