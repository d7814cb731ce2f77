"""Areas, borders and nearest points against analytic values and brute force."""

import json
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lotmetrics.operators import geometry as G
from lotmetrics.operators import spatial

RINGS = "array<array<array<double>>>"


def polygons(spark, rows, key="place"):
    rows = [(k, rings and [[[float(v) for v in p] for p in r] for r in rings]) for k, rings in rows]
    return spark.createDataFrame(rows, f"{key} string, rings {RINGS}")


def box(x, y, w, h):
    return [[x, y], [x + w, y], [x + w, y + h], [x, y + h]]


def shares(spark, places, zones, cell):
    return {r["place"]: r for r in G.covered_shares(polygons(spark, places), polygons(spark, zones, "zone"), cell).collect()}


@pytest.mark.parametrize("cell", [0.3, 1.0, 50.0])
def test_covered_shares(spark, cell):
    """Triangles, holes, islands inside holes, zones that overlap, negative coordinates, closed rings."""
    places = [
        ("square", [box(-1, -1, 2, 2)]), ("closed", [[*box(10, 0, 1, 1), [10.0, 0.0]]]), ("holed", [box(20, 0, 4, 4), box(21, 1, 2, 2), box(21.5, 1.5, 1, 1)]),
        ("triangle", [[[30, 0], [34, 0], [30, 4]]]), ("dry", [box(40, 0, 1, 1)]), ("line", [[[50, 0], [51, 0]]]), ("none", None), ("two parts", [box(60, 0, 1, 1), box(63, 0, 1, 1)]),
    ]
    zones = [
        ("a", [box(-1, -1, 1, 2)]), ("b", [box(-0.5, -1, 1, 1)]), ("c", [box(10.25, -5, 0.5, 10)]), ("d", [box(20, 0, 4, 2)]), ("e", [[[30, 0], [34, 4], [30, 4]]]),
        ("f", [box(60.5, 0, 3, 1)]), ("g", [box(60.5, 0, 3, 1)]), ("h", None),
    ]
    got = shares(spark, places, zones, cell)
    want = {"square": (4, 2 + 0.5), "closed": (1, 0.5), "holed": (16 - 4 + 1, 8 - 2 + 0.5), "triangle": (8, 4), "dry": (1, 0), "two parts": (2, 0.5 + 0.5)}
    assert set(got) == set(want)
    for k, (area, covered) in want.items():
        assert math.isclose(got[k]["area"], area, abs_tol=1e-9) and math.isclose(got[k]["covered"], covered, abs_tol=1e-9), k


def test_covered_shares_of_random_polygons(spark):
    """Stars and zigzags against a fine grid of points; the cell's size changes nothing."""
    rng = random.Random(3)

    def star(x, y, n):
        angles = sorted(rng.random() * 2 * math.pi for _ in range(n))
        return [[x + (0.3 + rng.random()) * math.cos(a), y + (0.3 + rng.random()) * math.sin(a)] for a in angles]

    places = [(f"p{k}", [star(rng.random() * 3, rng.random() * 3, 9)]) for k in range(6)]
    zones = [(f"z{k}", [star(rng.random() * 3, rng.random() * 3, 7), star(rng.random() * 3, rng.random() * 3, 5)]) for k in range(8)]
    one, many = shares(spark, places, zones, 100.0), shares(spark, places, zones, 0.37)
    for k in one:
        assert math.isclose(one[k]["area"], many[k]["area"], rel_tol=1e-9) and math.isclose(one[k]["covered"], many[k]["covered"], rel_tol=1e-9)
    step = 0.02
    axis = lambda c: (-1.5 + (F.col(c) + 0.5) * step)
    grid = spark.range(300 * 300).select((F.col("id") % 300).alias("i"), F.floor(F.col("id") / 300).alias("j")).select(axis("i").alias("x"), axis("j").alias("y"))
    zone = polygons(spark, zones, "polygon")
    for k, rings in places[:3]:
        inside = grid.where(spatial.inside(F.col("x"), F.col("y"), F.from_json(F.lit(json.dumps(rings)), RINGS))).withColumn("place", F.lit(k))
        wet = spatial.points_in_polygons(inside, zone, 0.5).select("x", "y").distinct().count()
        assert abs(inside.count() * step * step - one[k]["area"]) < 0.03 and abs(wet * step * step - one[k]["covered"]) < 0.03


@pytest.mark.parametrize("rows", [1, 3, 10000])
def test_covered_shares_in_batches(spark, rows):
    """One file's polygons are clipped by several tasks, and cells that go on over batches, alone in them or not, give the same areas."""
    rng = random.Random(5)
    places = [(f"p{k}", [box(k % 4 + 0.25, k // 4, 1, 1)]) for k in range(12)]
    zones = [(f"z{k}", [box(rng.uniform(0, 4), rng.uniform(0, 3), rng.uniform(0.1, 0.9), rng.uniform(0.1, 0.9))]) for k in range(30)]
    size, adaptive = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.enabled"
    before = {c: spark.conf.get(c) for c in (size, adaptive)}
    try:
        spark.conf.set(size, rows)
        spark.conf.set(adaptive, False)
        assert G.gridded(polygons(spark, zones, "zone").coalesce(1), "zone", 1.0).select(F.spark_partition_id()).distinct().count() > 1
        got = shares(spark, places, zones, 1.0)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    for k, rings in places:
        area, over = G.covered(rings, [z for _, z in zones])
        assert math.isclose(got[k]["area"], area, rel_tol=1e-9) and math.isclose(got[k]["covered"], over, abs_tol=1e-9)


def test_covered_parts_of_many_cells():
    """Cells worked out together, in small and in large portions, are as each by itself."""
    rng = random.Random(8)
    star = lambda n: [[[rng.uniform(0, 2), rng.uniform(0, 2)] for _ in range(n)], box(rng.uniform(0, 1), rng.uniform(0, 1), 0.5, 0.5)]
    cells = [([star(5) for _ in range(c % 3)], [star(4) for _ in range(c % 4)]) for c in range(12)]
    parts = [(c, own, p) for c, sides in enumerate(cells) for own, side in zip((False, True), sides[::-1], strict=True) for p in side]
    rings = pa.array([p for _, _, p in parts], pa.list_(pa.list_(pa.list_(pa.float64()))))
    want = [G.covered(p, cells[c][1]) for c, own, p in parts if own]
    for most in (1, 40, 2**15):
        rows, whole, over = G.covered_parts(np.array([c for c, _, _ in parts]), np.array([o for _, o, _ in parts]), rings, most)
        assert [parts[i][1] for i in rows] == [True] * len(want)
        assert np.allclose(whole, [w for w, _ in want]) and np.allclose(over, [o for _, o in want])


def test_borders_with_other_corners(spark):
    """One side drawn in one piece, the other in three; an island's part inside the other place; a place of two parts that touch."""
    left = [box(-9.0, 40.0, 0.5, 0.6)]
    right = [[[-8.5, 40.0], [-8.0, 40.0], [-8.0, 40.6], [-8.5, 40.6], [-8.5, 40.4], [-8.5, 40.1]]]
    halves = [box(-8.0, 40.0, 0.5, 0.3), box(-8.0, 40.3, 0.5, 0.3)]
    index = G.edge_index(polygons(spark, [("left", left), ("right", right), ("halves", halves), ("null", None)]), 4, 0.05)
    km = {(r["place"], r["neighbour"]): r["km"] for r in G.borders(index).collect()}
    tall = math.radians(0.6) * 6371
    assert set(km) == {("left", "right"), ("right", "left"), ("right", "halves"), ("halves", "right")}
    assert all(math.isclose(v, tall, rel_tol=1e-9) for v in km.values())
    rows = {r["place"]: r for r in G.coasts(index).collect()}
    # the common edge of the halves lies inside their place
    assert math.isclose(rows["halves"]["outer_km"], rows["halves"]["border_km"] - tall, rel_tol=1e-9)
    wide = lambda lat, deg: 2 * 6371 * math.asin(math.cos(math.radians(lat)) * math.sin(math.radians(deg / 2)))
    assert math.isclose(rows["left"]["coast_km"], tall + wide(40.0, 0.5) + wide(40.6, 0.5), rel_tol=1e-6)
    assert rows["left"]["coastal"] and not rows["halves"]["coastal"] and rows["right"]["neighbours"] == 2


def test_spatial_table(spark):
    hole = [box(-8.0, 39.0, 0.4, 0.2), box(-7.9, 39.05, 0.1, 0.1)[::-1]]
    row = G.spatial_table(polygons(spark, [("a", hole)])).first()
    assert math.isclose(row["area_km2"], (0.08 - 0.01) * 110.57 * 111.32 * math.cos(math.radians(row["lat"])), rel_tol=1e-9)
    assert math.isclose(row["lon"], (0.08 * -7.8 - 0.01 * -7.85) / 0.07, rel_tol=1e-9) and math.isclose(row["lat"], 39.1, rel_tol=1e-6)
    assert math.isclose(G.covered(hole, [])[0], 0.07, rel_tol=1e-9)


def km(a, b):
    h = math.sin(math.radians(b[0] - a[0]) / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(h, 1.0)))


@pytest.mark.parametrize(("k", "levels"), [(1, 1), (1, 7), (4, 3)])
def test_nearest_of_many(spark, k, levels):
    """500 centres, a third of them in one town, some at one point, on both sides of the date line and at a pole."""
    rng = random.Random(k)
    spot = lambda: (rng.uniform(-90, 90), rng.uniform(-180, 180))
    town = lambda: (38.7 + rng.uniform(-0.05, 0.05), -9.1 + rng.uniform(-0.05, 0.05))
    centres = [(f"c{i:03}", *(town() if i % 3 == 0 else spot())) for i in range(490)] + [(f"d{i}", 10.0, 179.99) for i in range(7)] + [("e", 90.0, 0.0), ("f", -90.0, 17.0), ("g", None, 3.0)]
    places = [(i, *(town() if i % 4 == 0 else spot())) for i in range(120)] + [(900, 10.0, -179.99), (901, 89.9, 100.0), (902, -90.0, 0.0), (903, None, None), (904, 10.0, 179.99)]
    got = {}
    for r in G.nearest(spark.createDataFrame(places, "place long, lat double, lon double"), spark.createDataFrame(centres, "centre string, lat double, lon double"), k, levels).collect():
        got.setdefault(r["place"], []).append((r["nth"], r["centre"], r["dist_km"]))
    assert set(got) == {p[0] for p in places if p[1] is not None}
    for i, *at in places:
        if at[0] is not None:
            want = sorted((km(at, c[1:]), c[0]) for c in centres if c[1] is not None)[:k]
            found = sorted(got[i])
            assert [n for n, _, _ in found] == list(range(1, k + 1))
            assert all(math.isclose(d, w[0], abs_tol=1e-6) for (_, _, d), w in zip(found, want, strict=True))
    assert sorted(got[904])[0][1] == "d0"


def test_nearest_of_none(spark):
    none = spark.createDataFrame([], "centre string, lat double, lon double")
    places = spark.createDataFrame([(1, 1.0, 1.0)], "place long, lat double, lon double")
    assert G.nearest(places, none).count() == 0
    assert spatial.nearest_centre(places, spark.createDataFrame([("x", 1.0, 1.5)], "centre string, lat double, lon double")).first()["band"] == "50–100 km"


def test_nearest_pairs_do_not_grow_with_places(spark, monkeypatch):
    """Pairs are of cubes: ten times the places near the same spots make no more of them; cubes dealt to many groups give brute force's rows."""
    rng = random.Random(11)
    spot = lambda: (rng.uniform(-90, 90), rng.uniform(-180, 180))
    spots = [spot() for _ in range(60)]
    centres = [(f"c{i:03}", *spot()) for i in range(300)]
    frame = spark.createDataFrame(centres, "centre string, lat double, lon double")
    pairs, stored = [], G.stored

    def counted(df):
        out = stored(df)
        pairs.extend([out.count()] if "_total" in out.columns else [])
        return out

    monkeypatch.setattr(G, "stored", counted)
    sizes = []
    for copies in (1, 10):
        places = [(n * 100 + i, *at) for n in range(copies) for i, at in enumerate(spots)]
        pairs.clear()
        near = G.nearest(spark.createDataFrame(places, "place long, lat double, lon double"), frame, 2, 4, most=10, rows_a_group=7)
        sizes.append(list(pairs))
        got = {(r["place"], r["nth"]): (r["centre"], r["dist_km"]) for r in near.collect()}
        assert len(got) == 2 * len(places)
        for i, *at in places:
            for n, (d, c) in enumerate(sorted((km(at, c[1:]), c[0]) for c in centres)[:2], 1):
                assert got[i, n][0] == c and math.isclose(got[i, n][1], d, abs_tol=1e-6)
    assert sizes[0] == sizes[1] and len(sizes[0]) > 1
