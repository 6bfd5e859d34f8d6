import math
import random

import pytest
from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.functions import projection as R
from strollgraph.operators import labels as L
from strollgraph.operators import overlay as O
from strollgraph.operators import sites as D
from strollgraph.operators import spatial as S
from worlds import box


def shapes(spark, rows, key="k"):
    return spark.createDataFrame(rows, f"{key} string, rings {G.RINGS}")


TRIANGLE = [[(0.0, 0.0), (10.0, 0.0), (0.0, 10.0), (0.0, 0.0)]]
RING = [box(0, 0, 100, 100)[0], box(40, 40, 60, 60)[0]]


def test_areas_and_holes(spark):
    rows = shapes(spark, [("t", TRIANGLE), ("r", RING)]).selectExpr("k", f"{G.polygon_area('rings')} a").collect()
    assert {r["k"]: r["a"] for r in rows} == {"t": 50.0, "r": 9600.0}


def test_overlap_area_of_sloping_shapes(spark):
    a = S.polygon_pieces(shapes(spark, [("t", TRIANGLE), ("ring", RING)], "a"))
    b = S.polygon_pieces(shapes(spark, [("half", box(0, 0, 5, 20)), ("in_hole", box(45, 45, 55, 55)), ("over", box(50, 50, 70, 55))], "b"))
    got = {(r["a"], r["b"]): r["overlap_m2"] for r in S.overlap_areas(a, b, "a", "b").collect()}
    assert got.pop(("t", "half")) == pytest.approx(37.5)
    assert got.pop(("ring", "over")) == pytest.approx(50.0)
    assert got.pop(("ring", "half")) == pytest.approx(100.0)
    assert got == {}


def test_pieces_of_a_large_polygon_add_up(spark):
    n = 1200
    circle = [(1000 * math.cos(2 * math.pi * i / n), 1000 * math.sin(2 * math.pi * i / n)) for i in range(n)]
    circle.append(circle[0])
    frame = shapes(spark, [("c", [circle])])
    pieces = S.polygon_pieces(frame, cell=300.0)
    rows = pieces.selectExpr(f"{G.signed_area('edges')} a").collect()
    whole = n / 2 * 1000**2 * math.sin(2 * math.pi / n)
    assert len(rows) > 20 and sum(r["a"] for r in rows) == pytest.approx(whole, rel=1e-9)


def test_union_area_of_random_triangles_matches_sampling(spark):
    rng = random.Random(5)
    rows = []
    for i in range(12):
        pts = [(rng.uniform(0, 100), rng.uniform(0, 100)) for _ in range(3)]
        rows.append((f"c{i:02d}", f"s{i}", "", "{}", [pts + pts[:1]]))
    land = spark.createDataFrame(
        rows, f"component_id string, source_id string, name string, source_attributes string, rings {G.RINGS}"
    )
    total = D.form_sites(land).sites.agg(F.sum("area_ha")).first()[0] * 10000

    def inside(t, x, y):
        (ax, ay), (bx, by), (cx, cy) = t[:3]
        s = [(bx - ax) * (y - ay) - (by - ay) * (x - ax), (cx - bx) * (y - by) - (cy - by) * (x - bx), (ax - cx) * (y - cy) - (ay - cy) * (x - cx)]
        return min(s) >= 0 or max(s) <= 0

    n, step = 0, 0.25
    for i in range(400):
        for j in range(400):
            x, y = (i + 0.5) * step, (j + 0.5) * step
            n += any(inside(r[4][0], x, y) for r in rows)
    assert total == pytest.approx(n * step * step, rel=0.01)


def test_same_shape_from_other_parts_has_the_same_hash(spark):
    def sites(rows):
        frame = spark.createDataFrame(
            [(c, c, "", "{}", r) for c, r in rows],
            f"component_id string, source_id string, name string, source_attributes string, rings {G.RINGS}",
        )
        return D.form_sites(frame).sites.first()

    one = sites([("a", box(0, 0, 20, 10))])
    two = sites([("b", box(0, 0, 12, 10)), ("c", box(8, 0, 20, 10))])
    other = sites([("d", box(0, 0, 21, 10))])
    assert one["geometry_sha256"] == two["geometry_sha256"] != other["geometry_sha256"]
    assert one["area_ha"] == pytest.approx(two["area_ha"])


def test_copies_cost_no_pairs(spark):
    rows = [(f"c{i:03d}", "s", "", "{}", box(0, 0, 10, 10)) for i in range(200)]
    land = spark.createDataFrame(
        rows, f"component_id string, source_id string, name string, source_attributes string, rings {G.RINGS}"
    )
    site = D.form_sites(land).sites.collect()
    assert len(site) == 1 and site[0]["component_count"] == 200 and site[0]["area_ha"] == pytest.approx(0.01)


def test_clip_with_hole_is_the_plain_intersection(spark):
    polygons = shapes(spark, [("in", box(5, 5, 20, 20)), ("cut", box(30, 45, 70, 55)), ("round", box(35, 35, 65, 65)), ("edge", box(90, 90, 110, 110)), ("out", box(200, 0, 210, 10))])
    mask = spark.createDataFrame([(RING,)], f"rings {G.RINGS}")
    got = O.clip_polygons(polygons, "k", mask).selectExpr("k", "part_no", "size(rings) n", f"{G.polygon_area('rings')} a").collect()
    areas = {}
    for r in got:
        areas.setdefault(r["k"], []).append((r["a"], r["n"]))
    assert areas.pop("in") == [(225.0, 1)]
    assert sorted(areas.pop("cut")) == [(100.0, 1), (100.0, 1)]
    assert areas.pop("round") == [(500.0, 2)]
    assert areas.pop("edge") == [(100.0, 1)]
    assert areas == {}


def test_capsule_and_distance_match_sampling(spark):
    rng = random.Random(3)
    rows = [[tuple(rng.uniform(-10, 10) for _ in range(4)) for _ in range(2)] for _ in range(60)]
    seg = "struct<x0:double,y0:double,x1:double,y1:double>"
    frame = spark.createDataFrame(rows, f"s {seg}, e {seg}")
    got = frame.selectExpr(f"{G.capsule_span('s', 'e', 3.0)} c", f"{G.nearest_link('s', 'array(e)')} k").collect()

    def gap(p, e):
        dx, dy = e[2] - e[0], e[3] - e[1]
        t = max(0, min(1, ((p[0] - e[0]) * dx + (p[1] - e[1]) * dy) / (dx * dx + dy * dy)))
        return math.hypot(p[0] - e[0] - t * dx, p[1] - e[1] - t * dy)

    for (s, e), r in zip(rows, got):
        ds = [gap((s[0] + (s[2] - s[0]) * i / 2000, s[1] + (s[3] - s[1]) * i / 2000), e) for i in range(2001)]
        assert math.sqrt(r["k"]["d2"]) == pytest.approx(min(ds), abs=0.02)
        near = [i / 2000 for i, d in enumerate(ds) if d <= 3]
        if not near:
            assert r["c"] is None or r["c"]["t1"] - r["c"]["t0"] < 1e-3
        else:
            assert r["c"]["t0"] == pytest.approx(near[0], abs=2e-3) and r["c"]["t1"] == pytest.approx(near[-1], abs=2e-3)


def test_inner_point_lies_inside(spark):
    u_shape = [[(0.0, 0.0), (30.0, 0.0), (30.0, 30.0), (20.0, 30.0), (20.0, 10.0), (8.0, 10.0), (8.0, 30.0), (0.0, 30.0), (0.0, 0.0)]]
    pieces = S.polygon_pieces(shapes(spark, [("u", u_shape), ("r", RING), ("t", TRIANGLE)], "node"))
    points = L.site_points(pieces).selectExpr("site_id", "array(named_struct('x', easting, 'y', northing)) path")
    inside = O.points_in_areas(points, "site_id", pieces, "node").where("site_id = node")
    assert inside.count() == 3


def test_grid_conversion(spark):
    # Published worked example of the projection (Airy latitude and longitude).
    lat, lon = math.radians(52 + 39 / 60 + 27.2531 / 3600), math.radians(1 + 43 / 60 + 4.5177 / 3600)
    one = spark.range(1)
    p = one.selectExpr(f"{R.grid_from_airy(f'{lat}D', f'{lon}D')} p").first()["p"]
    assert p["x"] == pytest.approx(651409.903, abs=0.01) and p["y"] == pytest.approx(313177.270, abs=0.01)
    frame = spark.createDataFrame([(450000.0, 100000.0), (651409.9, 313177.3), (90000.0, 10000.0)], "x double, y double")
    back = frame.selectExpr("x", "y", f"{R.grid_to_lonlat('x', 'y')} g").selectExpr("x", "y", f"{R.lonlat_to_grid('g.x', 'g.y')} b", "g")
    for r in back.collect():
        assert r["b"]["x"] == pytest.approx(r["x"], abs=0.001) and r["b"]["y"] == pytest.approx(r["y"], abs=0.001)
    g = back.where("x = 651409.9").first()["g"]
    assert g["y"] == pytest.approx(52.65798, abs=2e-4) and g["x"] == pytest.approx(1.71605, abs=2e-4)
