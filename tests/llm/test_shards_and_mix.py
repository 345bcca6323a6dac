"""Feistel shards and source mixing."""

import random

import pytest
from brute import fill, mix as plain_mix
from pyspark.sql import functions as F

from tractscope.llm import source_mix, tables
from tractscope.llm.feistel_shards import assign_shards, domain, place, row_at

SCHEMA = "doc_id long, source string, size long"


@pytest.mark.parametrize("rows", [1, 2, 3, 5, 8, 16, 17, 99, 100, 101, 1000])
def test_place_is_a_permutation(rows):
    for seed in (0, 7):
        places = [place(i, rows, seed) for i in range(rows)]
        assert sorted(places) == list(range(rows))
        assert [row_at(p, rows, seed) for p in places] == list(range(rows))


def test_domain_is_close():
    for rows in range(1, 3000):
        a, b = domain(rows)
        assert rows <= a * b < rows + a


def test_seeds_shuffle_differently():
    orders = {tuple(place(i, 50, seed) for i in range(50)) for seed in range(20)}
    assert len(orders) == 20
    assert sum(place(i, 10_000, 3) < 5_000 for i in range(5_000)) in range(2300, 2700)


@pytest.mark.parametrize("rows", [0, 1, 7, 64, 1003])
def test_assigned_shards(spark, rows):
    docs = spark.range(rows).select(
        F.when(F.col("id") % 5 > 0, F.col("id")).alias("doc_id"),
        F.col("id").alias("size"),
        F.lit("x").alias("shard"),
        F.lit(1).alias("place_of_row"),
    )
    found = assign_shards(docs, ["doc_id", "size"], shards=4, seed=9).collect()
    assert len(found) == rows
    assert sorted(r.row_number for r in found) == list(range(rows))
    for r in found:
        assert divmod(place(r.row_number, rows, 9), 4) == (r.slot, r.shard)
    order = [(r.doc_id is None, r.doc_id or 0, r.size) for r in sorted(found, key=lambda r: r.row_number)]
    assert order == sorted(order)


def test_place_with_64_bit_numbers(spark):
    from tractscope.llm.feistel_shards import permuted

    rows = 10**13 + 7
    numbers = [0, 1, rows - 1, rows // 3, 2**40]
    frame = spark.createDataFrame([(n,) for n in numbers], "n long")
    found = frame.select("n", permuted(F.col("n"), rows, 5).alias("p")).collect()
    assert {r.n: r.p for r in found} == {n: place(n, rows, 5) for n in numbers}


def test_numbers_of_repeated_rows(spark):
    docs = spark.createDataFrame([(None,)] * 40 + [(1,)] * 60, "doc_id long")
    found = tables.numbered(docs, ["doc_id"], "at").collect()
    assert sorted(r["at"] for r in found) == list(range(100))
    assert all((r["at"] >= 60) == (r.doc_id is None) for r in found)


def made_rows(seed, count):
    r = random.Random(seed)
    sources = ["hot"] * 6 + ["b", "Z", "é", None, "tiny", "zero"]
    rows = []
    for i in range(count):
        source = r.choice(sources)
        size = 0 if source == "zero" else 1 if source == "tiny" else r.choice([0, 5, 50, 400, None])
        rows.append((r.choice([i, i, i, None, -i]), source, size))
    return rows + rows[:5]


@pytest.mark.parametrize("seed,count", [(1, 400), (2, 60), (3, 5), (4, 0)])
def test_mix_equals_plain_python(spark, seed, count):
    rows = made_rows(seed, count) if count else []
    found = source_mix.mix(spark.createDataFrame(rows, SCHEMA), seed=seed).collect()
    got = sorted(((r.doc_id, r.source, r["size"], r.target, r.repeats) for r in found), key=repr)
    assert got == sorted(plain_mix(rows, seed), key=repr)
    assert all(r.repeats <= 3 for r in found)


def test_mix_comes_near_its_targets(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", 20 + i * 37 % 400) for i in range(3000)]
    found = source_mix.mix(spark.createDataFrame(rows, SCHEMA), seed=5)
    for r in found.groupBy("source").agg(
        F.sum(F.col("size") * F.col("repeats")).alias("taken"), F.first("target").alias("target")
    ).collect():
        assert abs(r.taken - r.target) <= 210  # half of the longest
    again = source_mix.mix(spark.createDataFrame(rows, SCHEMA).repartition(7), seed=5)
    assert sorted(found.collect()) == sorted(again.collect())


def window_inputs(spark, frame):
    """Rows that come into each window of a frame's plan."""
    todo, found = [frame._jdf.queryExecution().optimizedPlan()], []
    while todo:
        node = todo.pop()
        children = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Window":
            rows = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows
            found.append(rows(spark._jsparkSession, children[0]).count())
        todo += children
    return found


@pytest.mark.parametrize("shared", [None, 77], ids=["no id", "one id"])
def test_rows_that_share_an_id_are_not_ordered_as_one_group(spark, monkeypatch, shared):
    rows = [(shared if i % 4 else i, "a" if i % 3 else "b", 5 + i % 11) for i in range(4000)]
    counts, written = [], source_mix.write_once

    def watched(frame, label):
        counts.extend(window_inputs(spark, frame))
        return written(frame, label)

    monkeypatch.setattr(source_mix, "write_once", watched)
    monkeypatch.setattr(source_mix, "ROW_BITS", 4, raising=False)
    found = source_mix.mix(spark.createDataFrame(rows, SCHEMA), seed=3).collect()
    got = sorted(((r.doc_id, r.source, r["size"], r.target, r.repeats) for r in found), key=repr)
    assert got == sorted(plain_mix(rows, 3), key=repr)
    assert max(counts) <= 600  # ranges, kinds and blocks, of 4,000 rows


def test_given_weights_and_caps(spark):
    sources = {"a": 100, "b": 10, "c": 1000}
    weights = {"a": 5.0, "b": 5.0, "c": 1.0}
    frame = spark.createDataFrame(
        [(s, n, weights[s]) for s, n in sources.items()], "source string, source_size long, weight double"
    )
    found = {r.source: r.target for r in source_mix.water_fill(frame, 1110.0, 3).collect()}
    assert found == pytest.approx(fill(sources, weights, 1110, 3))
    found = {r.source: r.target for r in source_mix.water_fill(frame, 99_999.0, 3).collect()}
    assert found == {s: 3.0 * n for s, n in sources.items()}


def test_word_count(spark):
    values = [None, "", " ", "a b", "a\u00a0b c", "\ta\n"]
    frame = spark.createDataFrame([(v,) for v in values], "t string")
    counts = [r.n for r in frame.select(source_mix.word_count(F.col("t")).alias("n")).collect()]
    assert counts == [0, 0, 0, 2, 2, 1]
