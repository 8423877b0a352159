"""Coverings, polygon joins, clips and projections against brute force and known values."""

import json
import math
import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from envflow import functions as X
from envflow.operators import polygons as P
from envflow.operators import raster as R
from envflow.operators.blocks import blocks


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


def edges(rings):
    return [(p, q) for ring in rings for p, q in zip(ring, ring[1:] + ring[:1], strict=True)]


def meet(a, b):
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])

    def cross(s, t):
        near = all(min(s[0][i], s[1][i]) <= max(t[0][i], t[1][i]) and min(t[0][i], t[1][i]) <= max(s[0][i], s[1][i]) for i in (0, 1))
        return near and turn(*s, t[0]) * turn(*s, t[1]) <= 0 and turn(*t, s[0]) * turn(*t, s[1]) <= 0

    return any(cross(s, t) for s in edges(a) for t in edges(b)) or any(inside(b, *r[0]) for r in a) or any(inside(a, *r[0]) for r in b)


def star(rng, x, y, size, points):
    """A ring around (x, y) whose corners lie at different distances."""
    return [[x + size * (0.3 + 0.7 * rng.random()) * math.cos(2 * math.pi * i / points), y + size * (0.3 + 0.7 * rng.random()) * math.sin(2 * math.pi * i / points)] for i in range(points)]


def shapes(rng, n, sizes):
    out = []
    for i in range(n):
        x, y, size = rng.uniform(-170, 170), rng.uniform(-80, 80), rng.choice(sizes)
        rings = [star(rng, x, y, size, rng.randrange(3, 9))]
        if rng.random() < 0.4:
            rings.append([[x + size * 0.15 * dx, y + size * 0.15 * dy] for dx, dy in ((-1, -1), (1, -1), (1, 1), (-1, 1))])  # a hole
        if rng.random() < 0.3:
            rings.append(star(rng, x + 3 * size, y, size / 2, 4))
        out.append((i, [r + r[:1] if rng.random() < 0.5 else r for r in rings]))  # closed or open
    return out


KIND = "array<array<array<double>>>"


@pytest.mark.parametrize("most", [4, 32])
def test_polygon_join_against_brute_force(spark, most):
    rng = random.Random(most)
    a, b = shapes(rng, 60, (0.01, 1, 20, 150)), shapes(rng, 80, (0.05, 2, 10))
    odd = [(900, None), (901, []), (902, [[]]), (903, [[[1.0, 1.0]]]), (904, [[[float("nan"), 1.0], [2.0, 2.0], [3.0, 1.0]]])]
    left = spark.createDataFrame([*a, *odd], f"a bigint, zone {KIND}").withColumns({c: F.lit(1) for c in ("level", "ix", "at", "certain", "inside")})
    got = P.polygon_join(left, spark.createDataFrame([*b, *odd], f"b bigint, area {KIND}"), "a", "b", "zone", "area", finest=0.01, most=most).collect()
    want = {(i, j) for i, s in a for j, t in b if meet(s, t)}
    assert len(got) == len(want) and {tuple(r) for r in got} == want and 100 < len(want) < 3000


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([0.01, 1.0, 40.0]), st.sampled_from([4, 16, 64]))
def test_coverings_are_bounded_and_whole(seed, size, most):
    """No more squares than asked for; every point of the shape is in one; squares called inside lie inside; squares don't overlap."""
    rng = random.Random(seed)
    rings = shapes(rng, 1, (size,))[0][1]
    cells = P.cover(P.edges_of(rings), 0.001, most)
    assert 0 < len(cells) <= max(4, most)
    box = lambda c: (c[1] * 0.001 * 2.0 ** c[0], c[2] * 0.001 * 2.0 ** c[0], 0.001 * 2.0 ** c[0])
    points = [p for ring in rings for p in ring] + [[rng.uniform(-200, 200), rng.uniform(-90, 90)] for _ in range(20)]
    x0, y0 = np.array([p for r in rings for p in r]).min(axis=0)
    points += [[x0 + 4 * size * rng.random(), y0 + 3 * size * rng.random()] for _ in range(60)]
    for i, (x, y) in enumerate(points):
        hit = [c for c in cells if (b := box(c))[0] <= x < b[0] + b[2] and b[1] <= y < b[1] + b[2]]
        assert len(hit) <= 1
        if i < sum(map(len, rings)) or inside(rings, x, y):
            assert hit
        if hit and hit[0][3]:
            assert inside(rings, x, y)


def test_a_country_costs_what_a_village_does(spark):
    """A world-wide box and a small one have a bounded covering, and their join is done at once."""
    square = lambda x, y, w: [[[x, y], [x + w, y], [x + w, y + w], [x, y + w]]]
    a = spark.createDataFrame([(1, square(-180.0, -90.0, 360.0)), (2, square(1.0, 1.0, 0.01))], f"a bigint, zone {KIND}")
    sizes = {r.a: r.n for r in P.covering(a, "a", "zone", 0.001).groupBy("a").agg(F.count("*").alias("n")).collect()}
    assert max(sizes.values()) <= P.MAX_CELLS
    edges_ = P.edges_of(square(-180.0, -90.0, 360.0))
    began = time.perf_counter()
    P.cover(edges_, 0.001)
    assert time.perf_counter() - began < 0.5


def test_what_one_square_holds_is_certain(spark):
    """Villages in a country need no exact test."""
    country = [[[-50.0, -50.0], [50.0, -50.0], [50.0, 50.0], [-50.0, 50.0]]]
    villages = [(i, [[[x, y], [x + 0.01, y], [x, y + 0.01]]]) for i in range(50) for x in [-20 + i * 0.7] for y in [i * 0.3 - 7]]
    a, b = spark.createDataFrame([(1, country)], f"a bigint, zone {KIND}"), spark.createDataFrame(villages, f"b bigint, zone {KIND}")
    pairs = P.candidate_pairs(P.covering(a, "a", "zone", 0.001), P.covering(b, "b", "zone", 0.001), "a", "b").collect()
    assert len(pairs) == 50 and all(r.certain for r in pairs)


def test_rings_of_geojson(spark):
    one, two = [[[0, 0], [4, 0], [4, 4]], [[1, 1], [2, 1], [2, 2]]], [[[9, 9], [10, 9], [10, 10]]]
    texts = [json.dumps(t) for t in ({"type": "Polygon", "coordinates": one}, {"type": "MultiPolygon", "coordinates": [one, two]}, {"type": "Point", "coordinates": [1, 2]})] + ["not json", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(P.rings_of(F.col("t"))).collect()]
    assert got == [one, one + two, None, None, None]


@pytest.mark.parametrize("inverted", [False, True])
def test_clip_equals_the_even_odd_rule_of_every_cell(spark, inverted):
    rng = random.Random(8)
    zones = shapes(rng, 12, (0.4, 3, 12)) + [(50, [[[0.0, 0.0], [5.0, 0.0], [5.0, 5.0], [0.0, 5.0]], [[1.0, 1.0], [4.0, 1.0], [4.0, 4.0], [1.0, 4.0]]]), (51, [[[-10.25, -10.25], [200.0, -10.25], [200.0, -9.75], [-10.25, -9.75]]]), (52, None), (53, [])]
    grid = (-30.0, -20.0, 0.5, 0.25)
    cells = [(r, c) for r in range(0, 160, 3) for c in range(0, 120)]
    zones = [(k, [[[x % 60 - 30, y % 40 - 20] for x, y in ring] for ring in z] if k < 50 else z) for k, z in zones]
    df = spark.createDataFrame(cells, "row int, col int").withColumns({"first": F.lit(1), "_v": F.lit(2)})
    got = P.clip(df, spark.createDataFrame(zones, f"k bigint, zone {KIND}"), "k", "zone", grid, inverted)
    held = {(r, c, k) for r, c in cells for k, z in zones if z and inside([ring for ring in z], grid[0] + (c + 0.5) * grid[2], grid[1] + (r + 0.5) * grid[3])}
    rows = [tuple(x) for x in got.select("row", "col", *([] if inverted else ["k"])).collect()]
    want = set(cells) - {(r, c) for r, c, _ in held} if inverted else held
    assert len(rows) == len(want) and set(rows) == want and len(want) > 100


def test_intervals_are_cut_in_blocks(spark):
    """A clip's join is an equi-join on row and block."""
    zone = spark.createDataFrame([(1, [[[0.0, 0.0], [5000.0, 0.0], [5000.0, 2.0], [0.0, 2.0]]])], f"k bigint, zone {KIND}")
    lines = P.scan_lines(zone, "k", "zone", (0.0, 0.0, 1.0, 1.0)).collect()
    assert sorted((r.row, r.first, r.last) for r in lines) == [(0, 0, 4999), (1, 0, 4999)]
    plan = P.clip(spark.range(10).selectExpr("id AS row", "id AS col"), zone, "k", "zone", (0.0, 0.0, 1.0, 1.0))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_cells_of_a_place_meet_shapes_together(spark):
    """Cells of one place and the shapes that hold it are lists until the end, of bounded length; no cell is lost."""
    square = [[[0.0, 0.0], [3.0, 0.0], [3.0, 3.0], [0.0, 3.0]]]
    zones = spark.createDataFrame([(k, square) for k in range(30)] + [(99, [[[9.0, 9.0], [10.0, 9.0], [10.0, 10.0]]])], f"k bigint, zone {KIND}")
    cells = spark.range(2500).selectExpr("1 AS row", "if(id = 7, null, id % 2) AS col", "id")
    got = P.clip(cells, zones, "k", "zone", (0.0, 0.0, 1.0, 1.0))
    assert "explode(__cells" in got._jdf.queryExecution().toString()
    assert got.columns == ["row", "col", "id", "k"] and got.distinct().count() == got.count() == 2499 * 30 and not got.where("k = 99").count()
    lists = blocks(cells.where("col IS NOT NULL"), ["row", "col"], "l", 100).selectExpr("size(l) AS n").collect()
    assert sum(r.n for r in lists) == 2499 and max(r.n for r in lists) < 200


@pytest.mark.parametrize("inverted", [False, True])
def test_nothing_of_a_clip_goes_by_the_driver(spark, tmp_path, monkeypatch, inverted):
    """A small file of shapes gives very many intervals, and a place long lists: none of them is broadcast."""
    spark.range(40).selectExpr("id AS k", "array(array(array(0D, 0D), array(900D + id, 0D), array(900D + id, 300D), array(0D, 300D))) AS zone").write.parquet(str(tmp_path / "zones"))
    zones, cells = spark.read.parquet(str(tmp_path / "zones")), spark.range(500).selectExpr("id % 300 AS row", "id * 7 % 1000 AS col", "id")
    plans, written = {}, P.written
    monkeypatch.setattr(P, "written", lambda df, name: plans.update({name: df._jdf.queryExecution().executedPlan().toString()}) or written(df, name))
    got = P.clip(cells, zones, "k", "zone", (0.0, 0.0, 1.0, 1.0), inverted)
    plans["last"] = got._jdf.queryExecution().executedPlan().toString()
    assert all("BroadcastHashJoin" not in plans[name] and "SortMergeJoin" in plans[name] for name in (["last"] if inverted else ["held", "last"]))
    want = {(i, k) for i in range(500) for k in range(40) if inside([[[0, 0], [900 + k, 0], [900 + k, 300], [0, 300]]], i * 7 % 1000 + 0.5, i % 300 + 0.5)}
    rows = [tuple(r) for r in got.select("id", *([] if inverted else ["k"])).collect()]
    want = {(i,) for i in set(range(500)) - {i for i, _ in want}} if inverted else want
    assert len(rows) == len(want) and set(rows) == want and len(want) > 20


@pytest.mark.parametrize("n", [3000, 4, 0])
def test_equal_shapes_are_clipped_once(spark, monkeypatch, n):
    """Copies of a shape are looked up once, if they are many, and lists of keys are bounded; rows of one key are one shape, and a key may be null."""
    square = lambda x: [[[x, 0.0], [x + 3.0, 0.0], [x + 3.0, 3.0], [x, 3.0]]]
    odd_rows = [(None, square(0.0)), (5000, square(0.0)), (5000, square(10.0)), (6000, square(0.0)), (6000, square(0.0))]
    zones = [(k, square(k % 2 * 10.0)) for k in range(n)] + odd_rows * (n > 0) + [(7000, [None, *square(0.0)]), (8000, None)]
    lines, scan_lines, lists, blocks_, gathered = [], P.scan_lines, [], P.blocks, P.gathered
    monkeypatch.setattr(P, "scan_lines", lambda shapes, *rest: lines.append(shapes.count()) or scan_lines(shapes, *rest))
    for name, f in (("blocks", blocks_), ("gathered", gathered)):
        monkeypatch.setattr(P, name, lambda *a, f=f: lists.append(f(*a)) or lists[-1])
    cells = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (2, 12, 2), (2, 20, 3), (None, 1, 4)], "row int, col int, id int")
    got = [tuple(r) for r in P.clip(cells, spark.createDataFrame(zones, f"k bigint, zone {KIND}"), "k", "zone", (0.0, 0.0, 1.0, 1.0)).select("id", "k").collect()]
    even, odd = ([*range(i, n, 2), *([None, 5000][i:] if n else [])] for i in (0, 1))
    assert len(got) == len(set(got)) and set(got) == {(i, k) for i, of in ((0, even), (1, even), (2, odd)) for k in of}
    sizes = [r[0] for r in lists[-1].selectExpr("size(__keys)").collect()]
    assert lines[0] < 12 and max(sizes, default=0) < 2048 and sum(sizes) == len(even) + len(odd)


def test_equal_shapes_are_joined_once(spark, monkeypatch):
    """Copies of a shape are one shape in the join, and all pairs of keys come back."""
    square = lambda x: [[[x, 0.0], [x + 2.0, 0.0], [x + 2.0, 2.0], [x, 2.0]]]
    a = spark.createDataFrame([(k, square(k % 2 * 10.0)) for k in range(60)], f"a bigint, zone {KIND}")
    b = spark.createDataFrame([(k, square(k % 3 * 10.0 + 1)) for k in range(90)], f"b bigint, area {KIND}")
    seen, covering = [], P.covering
    monkeypatch.setattr(P, "covering", lambda shapes, *rest: seen.append(shapes.count()) or covering(shapes, *rest))
    got = [tuple(r) for r in P.polygon_join(a, b, "a", "b", "zone", "area", finest=1.0).collect()]
    assert seen == [2, 3] and len(got) == len(set(got)) and set(got) == {(i, j) for i in range(60) for j in range(90) if i % 2 == j % 3}


def test_projections_there_and_back(spark):
    rng = random.Random(2)
    rows = [(rng.uniform(-179.9, 179.9), rng.uniform(-80, 84)) for _ in range(500)] + [(0.0, 0.0), (3.0, 0.0), (-177.0, -45.0), (105.85, 21.03)]
    df = spark.createDataFrame(rows, "lon double, lat double").withColumn("zone", F.floor((F.col("lon") + 180) / 6).cast("int") + 1)
    df = df.withColumn("m", X.lonlat_to_utm(F.col("lon"), F.col("lat"), F.col("zone"))).withColumn("s", X.lonlat_to_sinusoidal(F.col("lon"), F.col("lat")))
    df = df.withColumn("u", X.utm_to_lonlat(F.col("m.x"), F.col("m.y"), F.col("zone"), F.col("lat") < 0)).withColumn("t", X.sinusoidal_to_lonlat(F.col("s.x"), F.col("s.y")))
    for r in df.collect():
        assert max(abs(r.u.lon - r.lon), abs(r.u.lat - r.lat)) < 1e-7 and max(abs(r.t.lon - r.lon), abs(r.t.lat - r.lat)) < 1e-9
        assert 100_000 < r.m.x < 900_000
    # the length of the equator's degree and of the meridian's quarter on the ellipsoid, as published
    known = {(r.lon, r.lat): r.m for r in df.collect()}
    assert abs(known[3.0, 0.0].x - 500_000) < 1e-6 and abs(known[3.0, 0.0].y) < 1e-6
    quarter = spark.range(1).select(X.lonlat_to_utm(F.lit(3.0), F.lit(89.9999999), F.lit(31)).alias("m")).first().m.y
    assert abs(quarter / 0.9996 - 10_001_965.729) < 0.05


def test_reprojection_reads_wanted_tiles_only(spark, tmp_path):
    rng = np.random.default_rng(1)
    tiles = [(d, h, v, rng.normal(size=16).tolist()) for d in (1, 2) for h in range(26, 30) for v in range(5, 9)]
    spark.createDataFrame(tiles, "day int, h int, v int, cells array<double>").write.partitionBy("h", "v").parquet(str(tmp_path / "tiles"))
    stored = spark.read.parquet(str(tmp_path / "tiles"))
    points = [(i, 102.0 + i % 7 * 0.9, 9.0 + i // 7 * 0.9) for i in range(60)] + [(99, 179.0, 89.0)]
    got = R.reproject(stored, spark.createDataFrame(points, "i int, lon double, lat double"), "cells", 4)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [h" in plan.replace("isnotnull(h", "[h") or "h#" in plan.split("PartitionFilters:")[1].split("]")[0]
    have = {(d, h, v): c for d, h, v, c in tiles}
    want = {}
    for i, lon, lat in points:
        x, y = math.radians(lon) * math.cos(math.radians(lat)) * 6371007.181 / 1111950.5196666666 + 18, 9 - math.radians(lat) * 6371007.181 / 1111950.5196666666
        for d in (1, 2):
            if (d, int(x), int(y)) in have:
                want[d, i] = have[d, int(x), int(y)][int((y % 1) * 4) * 4 + int((x % 1) * 4)]
    assert {(r.day, r.i): r.value for r in got.collect()} == want and len(want) == 120


def test_lookup_shuffles_nothing(spark):
    from envflow import catalog

    plan = catalog.QUERIES["grid_resample"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
