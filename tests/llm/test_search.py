"""Exact top-k search against all pairs in plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tractscope.llm import topk_search

SCHEMA = "vec_id long, embedding array<float>, vec_label int"


def plain(rows, queries, k):
    def sound(vector):
        return vector is not None and all(x is not None and math.isfinite(x) for x in vector)

    def whole(vector):
        return [math.floor(256 * x) for x in vector]

    good = [(i, whole(v)) for i, v, _ in rows if i is not None and sound(v)]
    asked = {}
    for i, v, _ in queries:
        if i is not None and sound(v):
            asked[i] = min(asked.get(i, whole(v)), whole(v))
    out = []
    for q, v in asked.items():
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in good if i != q
        )
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def vectors(seed, count, dims):
    r = random.Random(seed)
    rows = []
    for i in range(count):
        kind = r.random()
        if kind < 0.3:
            v = [0.25] * dims
        elif kind < 0.35:
            v = r.choice([None, [], [None] * dims, [float("nan")] * dims, [float("inf")]])
        elif kind < 0.45:
            v = [r.choice([0.0, 0.5]) for _ in range(r.randint(1, dims + 3))]
        else:
            v = [r.randint(-128, 128) / 256 for _ in range(dims)]
        rows.append((r.choice([i, i, i, i, None if i % 9 == 0 else i // 2]), v, i))
    return rows


@pytest.mark.parametrize("seed,count,dims", [(1, 300, 8), (2, 40, 3), (3, 4, 2), (4, 0, 2)])
def test_equals_plain(spark, monkeypatch, seed, count, dims):
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", 16)
    monkeypatch.setattr(topk_search, "CHUNK_ROWS", 4)
    rows = vectors(seed, count, dims)
    frame = spark.createDataFrame(rows, SCHEMA)
    queries = frame.where(F.col("vec_id") % 5 == 0)
    found = topk_search.search(frame, queries, 5).collect()
    wanted = plain(rows, [r for r in rows if r[0] is not None and r[0] % 5 == 0], 5)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == wanted


def test_both_ways_to_deal_out(spark, monkeypatch):
    rows = vectors(7, 200, 6)
    frame = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", 32)
    monkeypatch.setattr(topk_search, "BROADCAST_BYTES", -1)
    found = topk_search.search(frame, frame.where(F.col("vec_id") % 2 == 0), 3).collect()
    wanted = plain(rows, [r for r in rows if r[0] is not None and r[0] % 2 == 0], 3)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == wanted


def test_large_scores(spark):
    rows = [(i, [float(2**20 * (i % 7 - 3)), 1.0], 0) for i in range(60)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = topk_search.search(frame, frame.where("vec_id < 6"), 4).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == plain(rows, rows[:6], 4)
