"""Tract of a point, against a direct computation, in both join plans."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tractscope.operators import locate, tract_index
from tractscope.operators.locate import attach_tract, count_by_tract
from tractscope.operators.tract_index import build_tract_index

# An L, the square in its notch, a square with a hole, a triangle, and two parts.
SHAPES = {
    "L": [[(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)]],
    "notch": [[(2, 2), (4, 2), (4, 4), (2, 4)]],
    "ring": [[(5, 0), (9, 0), (9, 4), (5, 4)], [(6, 1), (8, 1), (8, 3), (6, 3)]],
    "triangle": [[(0, 5), (3.3, 5.2), (1.1, 8.7)]],
    "parts": [[(5, 5), (6, 5), (6, 6), (5, 6)], [(7, 7), (8, 7), (8, 8), (7, 8)]],
    "closed": [[(-3, -3), (-1, -3), (-1, -1), (-3, -1), (-3, -3)]],
}


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for ends in zip(ring, ring[1:] + ring[:1]):
            (x1, y1), (x2, y2) = sorted(ends, key=lambda end: end[1])
            if y1 <= y < y2 and x < x1 + (y - y1) * ((x2 - x1) / (y2 - y1)):
                odd = not odd
    return odd


def expected_tract(text_x, text_y):
    try:
        x, y = float(text_x), float(text_y)
    except (TypeError, ValueError):
        return "n/a"
    return min((name for name, rings in SHAPES.items() if inside(rings, x, y)), default="n/a")


def boundaries(spark, shapes=SHAPES):
    rows = [
        (name, [[(float(x), float(y)) for x, y in ring] for ring in rings])
        for name, rings in shapes.items()
    ]
    kind = "tract string, rings array<array<struct<x:double,y:double>>>"
    return spark.createDataFrame(rows, kind)


@pytest.fixture(scope="module")
def points(spark):
    """Random points, points on borders and corners, unreadable ones, one hot point."""
    pick = random.Random(7)
    texts = [(f"{pick.uniform(-4, 10):.4f}", f"{pick.uniform(-4, 10):.4f}") for _ in range(1500)]
    texts += [(str(x / 2), str(y / 2)) for x in range(-7, 19) for y in range(-7, 18)]
    texts += [("x", "1"), ("1", "y"), (None, "1"), ("1", None), (None, None), ("NaN", "NaN")]
    texts += [("Infinity", "1"), ("1e300", "1"), ("1e0", "1"), (" 1.0", "1")]
    texts += [("3.0", "3.0")] * 1200 + [(None, "7")] * 300
    rows = [(i, x, y, f"k{i % 3}") for i, (x, y) in enumerate(texts)]
    return spark.createDataFrame(rows, "id int, longitude string, latitude string, k string")


@pytest.mark.parametrize("cell", [0.25, 1.0, 3.0, 50.0])
@pytest.mark.parametrize("limit", [2**30, 0], ids=["broadcast", "shuffle"])
def test_attach_tract(spark, points, cell, limit):
    index = build_tract_index(boundaries(spark), cell, limit)
    assert index.fits_broadcast == (limit > 0)
    rows = attach_tract(points, index).collect()
    assert len(rows) == points.count() == len({row.id for row in rows})
    wrong = [row for row in rows if row.tract != expected_tract(row.longitude, row.latitude)]
    assert wrong == []
    assert {row.tract for row in rows} == {*SHAPES, "n/a"}


@pytest.mark.parametrize("limit", [2**30, 0], ids=["broadcast", "shuffle"])
def test_count_by_tract(spark, points, limit):
    index = build_tract_index(boundaries(spark), 1.0, limit)
    found = {(r.tract, r.k): r.total_count for r in count_by_tract(points, index, ["k"]).collect()}
    rows = points.collect()
    assert found == Counter((expected_tract(r.longitude, r.latitude), r.k) for r in rows)
    assert sum(found.values()) == len(rows)


def test_heavy_coordinates_leave_the_shuffle(spark, points, monkeypatch):
    """With a low bound some coordinates are heavy and others not: rows stay the same."""
    monkeypatch.setattr(locate, "MAX_HEAVY", 10)
    index = build_tract_index(boundaries(spark), 1.0, 0)
    rows = attach_tract(points, index).collect()
    assert len(rows) == points.count()
    assert all(row.tract == expected_tract(row.longitude, row.latitude) for row in rows)


@pytest.mark.parametrize("cell", [0.5, 0.7, 1.0, 4.0])
def test_random_shapes(spark, cell):
    """Crossing itself, with corners on cell borders and level sides: the even-odd rule."""
    pick = random.Random(11)
    shapes = {}
    for n in range(12):
        ring = [(pick.randint(0, 12), pick.randint(0, 12)) for _ in range(pick.randint(3, 14))]
        inner = [(x / 2 + 3, y / 2 + 3) for x, y in ring[:4]]
        shapes[f"s{n:02d}"] = [ring, inner]
    rows = [(x / 4, y / 4) for x in range(-2, 52) for y in range(-2, 52)]
    rows += [(pick.uniform(0, 12), pick.uniform(0, 12)) for _ in range(500)]
    frame = spark.createDataFrame(rows, "x double, y double")
    for names in [["s00"], ["s01", "s02"], list(shapes)]:
        some = {name: shapes[name] for name in names}
        index = build_tract_index(boundaries(spark, some), cell)
        for row in attach_tract(frame, index, "x", "y").collect():
            matches = [n for n, rings in some.items() if inside(rings, row.x, row.y)]
            assert row.tract == min(matches, default="n/a")


def test_long_boundary(spark):
    """A ring of 2,000 corners: entries keep a few edges, and the answers stay exact."""
    ring = []
    for i in range(2000):
        angle = 2 * math.pi * i / 2000
        radius = 5 + 0.3 * math.sin(40 * angle) + 0.02 * math.sin(700 * angle)
        ring.append((radius * math.cos(angle), radius * math.sin(angle)))
    index = build_tract_index(boundaries(spark, {"wheel": [ring]}), 0.25)
    entries = index.cells.select(F.inline("candidates")).where("not fills")
    edges, turns = entries.agg(F.avg(F.size("edges")), F.avg(F.size("turns"))).first()
    assert edges < 40 and turns < 10
    pick = random.Random(2)
    rows = [(pick.uniform(-6, 6), pick.uniform(-6, 6)) for _ in range(1000)]
    rows += [(x, y) for x, y in ring[::7]]
    frame = spark.createDataFrame(rows, "x double, y double")
    for row in attach_tract(frame, index, "x", "y").collect():
        assert row.tract == ("wheel" if inside([ring], row.x, row.y) else "n/a")


def test_number_columns(spark):
    index = build_tract_index(boundaries(spark), 1.0)
    places = [(1.0, 1.0), (None, 1.0), (float("nan"), 0.5)]
    frame = spark.createDataFrame(places, "x double, y double")
    rows = attach_tract(frame, index, "x", "y").collect()
    assert Counter(row.tract for row in rows) == {"L": 1, "n/a": 2}


def test_overlapping_tracts_give_the_smallest(spark):
    square = [[(0, 0), (4, 0), (4, 4), (0, 4)]]
    index = build_tract_index(boundaries(spark, {"b": square, "a": square}), 0.5)
    frame = spark.createDataFrame([("2.1", "2.2"), ("0.1", "0.1")], "x string, y string")
    assert [row.tract for row in attach_tract(frame, index, "x", "y").collect()] == ["a", "a"]


def test_neighbours_share_every_border_point_once(spark):
    """Slanted border: points rounded onto it are in exactly one of the two tracts."""
    west = [[(0, 0), (1.7, 0), (2.9, 3.1), (0, 3.1)]]
    east = [[(1.7, 0), (5, 0), (5, 3.1), (2.9, 3.1)]]
    index = build_tract_index(boundaries(spark, {"w": west, "e": east}), 0.3)
    frame = spark.range(3000).select(
        (F.col("id") / 3000 * 3.1).alias("y"), (1.7 + F.col("id") / 3000 * 1.2).alias("x")
    )
    assert {r.tract for r in attach_tract(frame, index, "x", "y").collect()} <= {"w", "e"}


def test_no_boundaries(spark, points):
    index = build_tract_index(boundaries(spark).where("false"), 1.0)
    assert attach_tract(points, index).select("tract").distinct().collect() == [("n/a",)]


def test_most_cells_need_no_geometry(spark):
    index = build_tract_index(boundaries(spark), 0.05)
    filled = index.cells.agg(F.avg(F.col("sole_tract").isNotNull().cast("int"))).first()[0]
    assert filled > 0.75


def test_index_size_is_measured(spark):
    assert build_tract_index(boundaries(spark), 1.0, broadcast_bytes=10_000_000).fits_broadcast
    assert not build_tract_index(boundaries(spark), 1.0, broadcast_bytes=1000).fits_broadcast


def wheel(corners, radius=1.0):
    angles = [2 * math.pi * i / corners for i in range(corners)]
    return [[(radius * math.cos(a) * (1 + 0.05 * math.sin(9 * a)), radius * math.sin(a)) for a in angles]]


def test_index_follows_the_border(spark):
    """Twice the size is twice the border cells; inside, only coarse cells count."""
    rows = {}
    for radius in (0.5, 1.0):
        index = build_tract_index(boundaries(spark, {"w": wheel(600, radius)}), 0.04)
        whole = index.cells.where("sole_tract is not null").count()
        rows[radius] = index.cells.count() - whole, whole
    assert rows[1.0][0] < 2.6 * rows[0.5][0]
    assert rows[1.0][1] < 2500 + 6 * rows[1.0][0]


def test_dense_cells_are_cut_and_exact(spark):
    """Thousands of corners in one coarse cell: finer cells hold some, answers stay exact."""
    shapes = {"w": wheel(3000, 0.9), "v": [[(x + 1.2, y) for x, y in ring] for ring in wheel(900, 0.5)]}
    index = build_tract_index(boundaries(spark, shapes), 4.0)
    assert index.levels.count() > 0
    sides = index.cells.select(F.inline("candidates")).agg(F.avg(F.size("edges"))).first()[0]
    assert sides < 80
    pick = random.Random(5)
    rows = [(pick.uniform(-1, 2), pick.uniform(-1, 1)) for _ in range(1500)]
    rows += [(x, y) for rings in shapes.values() for x, y in rings[0][::9]]
    rows += [(i / 16, j / 16) for i in range(-16, 30) for j in range(-16, 17)]
    frame = spark.createDataFrame(rows, "x double, y double")
    for row in attach_tract(frame, index, "x", "y").collect():
        matches = [n for n, rings in shapes.items() if inside(rings, row.x, row.y)]
        assert row.tract == min(matches, default="n/a")


def test_unusable_boundaries_are_rejected(spark):
    kind = "tract string, rings array<array<struct<x:double,y:double>>>"
    good = [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]]
    bad = [
        ("null corner", [[(0.0, 0.0), None, (1.0, 1.0)]]),
        ("null number", [[(0.0, 0.0), (None, 1.0), (1.0, 1.0)]]),
        ("nan", [[(0.0, 0.0), (float("nan"), 1.0), (1.0, 1.0)]]),
        ("far", [[(0.0, 0.0), (1e300, 1.0), (1.0, 1.0)]]),
        ("null ring", [None]),
        ("no rings", []),
        ("null", None),
        (None, good),
    ]
    frame = spark.createDataFrame([("good", good), *bad], kind)
    with pytest.warns(UserWarning, match="8 tracts"):
        index = build_tract_index(frame, 0.5)
    assert index.rejected == 8
    points = spark.createDataFrame([(0.5, 0.5), (2.0, 2.0)], "x double, y double")
    assert [r.tract for r in attach_tract(points, index, "x", "y").collect()] == ["good", "n/a"]


def test_stored_index_is_built_once(spark, monkeypatch):
    built = []
    real = tract_index.build_tract_index
    monkeypatch.setattr(
        tract_index, "build_tract_index", lambda *given: built.append(1) or real(*given)
    )
    square = {"s": [[(0.1, 0.1), (4.7, 0), (4, 4), (0, 4)]]}
    for _ in range(2):
        index = tract_index.stored_tract_index(boundaries(spark, square).repartition(2), 0.5)
        points = spark.createDataFrame([(1.0, 1.0)], "x double, y double")
        assert attach_tract(points, index, "x", "y").first().tract == "s"
    assert len(built) == 1
    tract_index.stored_tract_index(boundaries(spark, {"s": [[(0, 0), (4, 0), (4, 4)]]}), 0.5)
    assert len(built) == 2


def test_shuffle_plan_reads_its_input_once(spark, points, tmp_path):
    points.write.parquet(f"{tmp_path}/points")
    stored = spark.read.parquet(f"{tmp_path}/points")
    index = build_tract_index(boundaries(spark), 1.0, 0)
    plan = attach_tract(stored, index)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("k#") and plan.count("Relation [id#") == 1


def test_dense_cells_of_the_shuffle_plan(spark, points, monkeypatch):
    monkeypatch.setattr(locate, "MIN_DENSE", 5)
    index = build_tract_index(boundaries(spark), 3.0, 0)
    for row in attach_tract(points, index).collect():
        assert row.tract == expected_tract(row.longitude, row.latitude)
