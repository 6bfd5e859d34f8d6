"""Nearest routes against the distance of every pair."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.operators import labels as L
from strollgraph.operators import spatial as S

ROUTES = f"route_index bigint, path {G.PATH}"


def ring(x, y, w, h, parts=1):
    corners = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
    out = [(a[0] + (b[0] - a[0]) * i / parts, a[1] + (b[1] - a[1]) * i / parts) for a, b in zip(corners, corners[1:] + corners[:1]) for i in range(parts)]
    return [(float(p), float(q)) for p, q in out + out[:1]]


def every_pair(pieces, routes, last):
    segments = S.path_segments(routes, []).select(F.col("s").alias("a_s"))
    pairs = segments.crossJoin(pieces.select(F.col("node").alias("b_node"), F.col("edges").alias("b_edges")))
    found = S.link_distance(pairs, last).groupBy("b_node").agg(F.min("link.d2").alias("d2"))
    near = {r.b_node: math.sqrt(r.d2) for r in found.collect()}
    return {r.node: near.get(r.node) for r in pieces.select("node").distinct().collect()}


@pytest.mark.parametrize("limit, last", [(10000.0, 6400.0), (120.0, 100.0)])
def test_equals_every_pair(spark, limit, last):
    rnd = random.Random(11)
    shapes = [(f"s{i % 40}", [ring(rnd.uniform(-9000, 9000), rnd.uniform(-9000, 9000), rnd.uniform(5, 400), rnd.uniform(5, 400))]) for i in range(50)]
    shapes += [("wide", [ring(-14000, 12000, 21000, 3000, 30)]), ("far", [ring(90000, 90000, 10, 10)]), ("on lines", [ring(250, 250, 500, 250)]),
               ("inside", [ring(-8000, -8000, 1000, 1000, 40)]), ("hole", [ring(3000, -6000, 2000, 2000, 30), ring(3500, -5500, 1000, 1000, 20)])]
    lines = [(i, [(x, y), (x + rnd.uniform(-900, 900), y + rnd.uniform(-900, 900))]) for i in range(30) for x, y in [(rnd.uniform(-9000, 3000), rnd.uniform(-9000, 9000))]]
    lines += [(100, [(-7600.0, -7600.0), (-7500.0, -7600.0)]), (101, [(4000.0, -5000.0), (4010.0, -5000.0)]), (102, [(0.0, 250.0), (250.0, 250.0)]),
              (103, [(7000.0, 7000.0), (7000.0, 7000.0)]), (104, [(2000.0, 3000.0), (2000.0, 8000.0), (2750.0, 8750.0)])]
    routes = spark.createDataFrame([(i, [(float(x), float(y)) for x, y in p]) for i, p in lines], ROUTES)
    pieces = S.polygon_pieces(spark.createDataFrame(shapes, f"node string, rings {G.RINGS}")).persist()
    got = {r.site_id: r.nearest_mapped_route_m for r in L.nearest_routes(pieces, routes, limit).collect()}
    want = every_pair(pieces, routes, last)
    assert set(got) == set(want) and got["far"] is None and got["inside"] == 0
    assert {k: v is None for k, v in got.items()} == {k: v is None for k, v in want.items()}
    assert all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want if want[k] is not None)


def test_no_routes_and_a_small_limit(spark):
    pieces = S.polygon_pieces(spark.createDataFrame([("a", [ring(0, 0, 10, 10)])], f"node string, rings {G.RINGS}"))
    none = spark.createDataFrame([], ROUTES)
    assert [tuple(r) for r in L.nearest_routes(pieces, none).collect()] == [("a", None)]
    one = spark.createDataFrame([(1, [(0.0, 0.0), (1.0, 0.0)])], ROUTES)
    assert [tuple(r) for r in L.nearest_routes(pieces, one, 10.0).collect()] == [("a", None)]
    assert [tuple(r) for r in L.nearest_routes(pieces, one).collect()] == [("a", 0.0)]


def test_measures_only_segments_that_can_be_nearest(spark, monkeypatch):
    """Most segments of the cells around a site are ruled out by their boxes; the kernels see the rest."""
    pieces = S.polygon_pieces(spark.createDataFrame([("a", [ring(0, 0, 20, 20)])], f"node string, rings {G.RINGS}"))
    routes = spark.createDataFrame([(i, [(0.0, 25.0 + i), (10.0, 25.0 + i)]) for i in range(90)], ROUTES)
    seen, measure = [], S.link_distance
    monkeypatch.setattr(S, "link_distance", lambda pairs, d: seen.append(pairs.count()) or measure(pairs, d))
    assert [tuple(r) for r in L.nearest_routes(pieces, routes).collect()] == [("a", 5.0)]
    assert 0 < sum(seen) < 40


def test_sites_are_read_from_the_stored_pieces(spark):
    land = spark.createDataFrame([("u", [ring(10.0, 10.0, 600.0, 600.0, 30)])], f"node string, rings {G.RINGS}")
    routes = spark.createDataFrame([(0, [(700.0, 100.0), (700.0, 200.0)])], ROUTES)
    near = L.nearest_routes(S.polygon_pieces(land), routes)
    assert "Window" not in near._jdf.queryExecution().optimizedPlan().toString()  # nothing is cut up again
    assert [tuple(r) for r in near.collect()] == [("u", 90.0)]
