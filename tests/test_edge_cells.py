"""Polygons of many edges are cut edge by edge and behave like whole ones."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.operators import spatial as S


def star(cx, cy, r, n, rnd):
    ring = [(cx + r * q * math.cos(2 * math.pi * i / n), cy + r * q * math.sin(2 * math.pi * i / n)) for i, q in enumerate(rnd.uniform(0.4, 1) for _ in range(n))]
    return ring + ring[:1]


def square(x0, y0, size, step):
    n = size // step
    sides = [(i * step, 0) for i in range(n)] + [(size, i * step) for i in range(n)] + [(size - i * step, size) for i in range(n)] + [(0, size - i * step) for i in range(n)]
    ring = [(float(x0 + x), float(y0 + y)) for x, y in sides]
    return ring + ring[:1]


@pytest.fixture(scope="module")
def shapes(spark):
    rnd = random.Random(3)
    hole = [(5000 + 0.3 * x, 5000 + 0.3 * y) for x, y in star(0, 0, 1000, 100, rnd)]
    rows = [
        ("star", [star(0, 0, 2000, 300, rnd)]),
        ("on lines", [square(0, 0, 1000, 10)]),  # all sides run along grid lines
        ("hole", [star(5000, 5000, 3000, 500, rnd), hole]),
        ("hole on lines", [square(-6000, 0, 3000, 50), square(-5000, 1000, 500, 25)]),
        ("one cell", [square(6010, 10, 100, 5)]),
        ("few edges", [square(7000, 0, 700, 700)]),
        ("copy", [square(0, 0, 1000, 10)]),
    ]
    return spark.createDataFrame(rows, f"node string, rings {G.RINGS}")


@pytest.fixture(scope="module")
def both(shapes):
    pick = lambda df: df.select("node", "edges", *S.BOUNDS).persist()
    return pick(S.whole_polygons(shapes)), pick(S.polygon_pieces(shapes))


@pytest.fixture(scope="module")
def segments(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(400):
        x, y = rnd.uniform(-7000, 8000), rnd.uniform(-3000, 8000)
        if i % 3 == 0:  # along and across grid lines, through corners
            x, y = round(x / 250) * 250.0, round(y / 250) * 250.0
        dx, dy = rnd.choice([(1500, 0), (0, -2000), (rnd.uniform(-2000, 2000), rnd.uniform(-2000, 2000)), (750, 750), (0, 0)])
        rows.append((i, (x, y, x + dx, y + dy)))
    return S.segment_bounds(spark.createDataFrame(rows, "i int, s struct<x0:double,y0:double,x1:double,y1:double>"))


def test_area_and_outline_are_kept(both):
    def measure(df):
        rows = df.groupBy("node").agg(
            F.sum(F.expr(G.signed_area("edges"))).alias("a"), F.sum(F.expr(G.edges_length(G.outline_edges("edges")))).alias("l")
        ).collect()
        return {r.node: (pytest.approx(r.a, rel=1e-9), pytest.approx(r.l, rel=1e-9)) for r in rows}

    whole, pieces = (measure(df) for df in both)
    assert {k: (a.expected, l.expected) for k, (a, l) in pieces.items()} == whole


def test_rows_hold_the_edges_of_one_cell(shapes, both):
    many = both[1].where("node in ('star', 'hole', 'hole on lines', 'on lines')")
    assert many.agg(F.max(F.size("edges"))).first()[0] < 64
    assert many.where(f"xmax - xmin > {S.EDGE_CELL_M} + 1e-6 or ymax - ymin > {S.EDGE_CELL_M} + 1e-6").isEmpty()
    assert both[1].where("node = 'one cell'").count() == 1


def test_covered_stretches_are_the_same(both, segments):
    def covers(shapes):
        spans = S.covered_spans(segments, shapes)
        found = S.union_measures(spans, ["a_i", "b_node"], {"l": F.col("is_left"), "r": ~F.col("is_left")}).collect()
        return {(r.a_i, r.b_node): (r.l, r.r) for r in found if r.l + r.r > 1e-9}

    whole, pieces = (covers(df) for df in both)
    assert len(whole) > 80 and set(whole) == set(pieces)
    assert all(whole[k] == pytest.approx(pieces[k], abs=1e-7) for k in whole)


def test_distances_are_the_same(both, segments):
    def links(shapes):
        found = S.link_distance(S.near_pairs(segments, shapes, 700.0), 700.0).groupBy("a_i", "b_node").agg(F.min("link.d2").alias("d")).collect()
        return {(r.a_i, r.b_node): r.d for r in found}

    whole, pieces = (links(df) for df in both)
    assert len(whole) > 150 and set(whole) == set(pieces)
    assert all(whole[k] == pytest.approx(pieces[k], abs=1e-5) for k in whole)


def test_a_wide_park_costs_its_edges_and_inner_cells(spark):
    """40 km by 40 km with 1,600 edges: before, every 250 m cell of its box met all edges."""
    park = spark.createDataFrame([("park", [square(125, 125, 40000, 100)])], f"node string, rings {G.RINGS}")
    pieces = S.polygon_pieces(park).select(F.size("edges").alias("n"), F.expr(f"size({G.outline_edges('edges')})").alias("real")).persist()
    rows, edges, real = pieces.agg(F.count("*"), F.sum("n"), F.sum("real")).first()
    assert rows == 161 * 161
    assert real <= 2 * 1600 and edges <= real + 4 * rows
