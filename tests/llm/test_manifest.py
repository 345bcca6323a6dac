"""Merkle manifest against a plain tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tractscope.llm import merkle_manifest as mm

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    texts = [None if v is None else str(v) for v in row]
    return h(*["-" if t is None else f"{len(t.encode())}:{t}" for t in texts])


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        other = at ^ 1
        out.append((at & 1, level[other] if other < len(level) else None))
        at >>= 1
    return out


def proofs(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: (r[0] is None, r[0] or 0, leaf(r)))
    trees = {g: tree([leaf(r) for r in groups[g]]) for g in order}
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for i, g in enumerate(order):
        for k, row in enumerate(groups[g]):
            steps = path(trees[g], k) + path(top, i)
            node = leaf(row)
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                node = leaf((*row[:3], row[3] + 1, row[4]))
            for right, sibling in steps:
                if sibling is None:
                    node = h(node)
                else:
                    node = h(sibling, node) if right else h(node, sibling)
            proof = h(*[s for _, s in steps if s])
            root = top[-1][0]
            out.append((row[0], leaf(row), trees[g][-1][0], root, proof, node, node == root))
    return out


def plain(rows):
    return sorted(map(repr, rows))


def many(sizes, seed=5):
    r = random.Random(seed)
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            doc_id = r.choice([None, r.randrange(10**6), r.randrange(50), -r.randrange(9)])
            text = r.choice([None, "", "Ünd 日本", "x" * r.randrange(40)])
            n_chars = r.choice([None, 0, 7, 2**63 - 1])
            rows.append((doc_id, r.choice([None, "", "a"]), lang, n_chars, text))
            if r.random() < 0.1:
                rows.append(rows[-1])
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "sizes",
    [{"a": 1}, {None: 1, "-": 2, "": 3}, {"de": 300, None: 70, "=": 9}, {f"l{i}": 2 for i in range(300)}],
    ids=["one leaf", "odd groups", "two segments", "many groups"],
)
def test_proofs_equal_a_plain_tree(spark, sizes):
    rows = many(sizes)
    found = mm.document_proofs(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert plain(map(tuple, found.collect())) == plain(proofs(rows))


def test_three_segments(spark, monkeypatch):
    """Segments of two levels, so that a few hundred leaves need five of them."""
    monkeypatch.setattr(mm, "SEGMENT", 2)
    monkeypatch.setattr(mm, "WIDTH", 4)
    rows = many({"a": 260, "b": 1, "c": 17, None: 5})
    found = mm.document_proofs(spark.createDataFrame(rows, SCHEMA))
    assert plain(map(tuple, found.collect())) == plain(proofs(rows))


def test_repeated_rows_share_records(spark):
    rows = [(1, "s", "de", 3, "abc")] * 600
    found = mm.document_proofs(spark.createDataFrame(rows, SCHEMA)).collect()
    assert plain(map(tuple, found)) == plain(proofs(rows))


def test_empty_table_and_clashing_columns(spark):
    rows = many({"a": 5})
    docs = spark.createDataFrame(rows, SCHEMA)
    assert mm.document_proofs(docs.limit(0)).collect() == []
    for name in ("group_key", "rank", "digest", "place", "path", "levels", "root", "leaves"):
        docs = docs.withColumn(name, F.lit("x"))
    assert plain(map(tuple, mm.document_proofs(docs).collect())) == plain(proofs(rows))


def test_requests_for_some_leaves(spark):
    """A few requests descend alone; their proofs fold to the root."""
    docs = spark.range(1000).select("id", F.concat(F.lit("t"), "id").alias("t"))
    manifest = mm.build(docs, F.lit("g"), F.col("id"), mm.leaf_digest(F.col("t")), {"id": F.col("id")})
    wanted = manifest.leaves.where("id in (0, 255, 256, 999)")
    proved = mm.prove(manifest, wanted)
    rows = proved.select("id", "root", mm.fold(F.col("digest"), F.col("path")).alias("f")).collect()
    assert sorted(r.id for r in rows) == [0, 255, 256, 999]
    levels = tree([h(f"{len(f't{i}')}:t{i}") for i in range(1000)])
    assert {r.root for r in rows} == {r.f for r in rows} == {levels[-1][0]}
