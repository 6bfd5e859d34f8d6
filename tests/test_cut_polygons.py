"""Polygons that are cut along the grid behave like uncut ones."""

import math

import pytest
from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.operators import labels as L
from strollgraph.operators import overlay as O
from strollgraph.operators import sites as D
from strollgraph.operators import spatial as S

LAND = f"component_id string, source_id string, name string, source_attributes string, rings {G.RINGS}"


def dense(corners, parts):
    """Closed ring with every side divided into ``parts``."""
    ring = []
    for (x0, y0), (x1, y1) in zip(corners, corners[1:] + corners[:1]):
        ring += [(x0 + (x1 - x0) * i / parts, y0 + (y1 - y0) * i / parts) for i in range(parts)]
    return [(float(x), float(y)) for x, y in ring + ring[:1]]


def rectangle(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


WIDE = rectangle(19005.0, 1000.0, 21005.0, 1214.0)
U = [(19000.0, 1000.0), (21000.0, 1000.0), (21000.0, 2000.0), (20337.0, 2000.0), (20337.0, 1337.0), (19663.0, 1337.0), (19663.0, 2000.0), (19000.0, 2000.0)]


def land(spark, rings):
    return spark.createDataFrame([(k, k, k, None, r) for k, r in rings], LAND)


def frame(spark, rings, key="node"):
    return spark.createDataFrame(rings, f"{key} string, rings {G.RINGS}")


def test_repeated_vertices(spark):
    ring = [(0.0, 0.0), (10.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
    site = D.form_sites(land(spark, [("a", [ring])])).sites.first()
    plain = D.form_sites(land(spark, [("a", [dense(rectangle(0, 0, 10, 10), 1)])])).sites.first()
    assert site.area_ha == pytest.approx(0.01) and site.geometry_sha256 == plain.geometry_sha256


@pytest.mark.parametrize("parts", [1, 2, 200])
def test_shape_hash_and_point_ignore_vertices(spark, parts):
    shape = land(spark, [("a", [dense(WIDE, parts)])])
    catalogue = D.form_sites(shape)
    site = catalogue.sites.first()
    plain = D.form_sites(land(spark, [("a", [dense(rectangle(1005.0, 1000.0, 3005.0, 1214.0), 1)])])).sites.first()
    whole = D.outline_hash(S.path_segments(frame(spark, [("a", [dense(WIDE, 1)])]).select("node", F.col("rings")[0].alias("path")), ["node"]).select("node", "s", F.col("s").alias("edge")), "node").first()
    assert site.area_ha == pytest.approx(plain.area_ha) == pytest.approx(42.8)
    assert site.geometry_sha256 == whole.geometry_sha256
    point = L.site_points(D.site_shapes(catalogue.membership, shape)).first()
    assert (point.easting, point.northing) == (20005.0, 1107.0)


@pytest.mark.parametrize("parts", [1, 2, 200])
def test_distance_into_a_mouth_on_the_grid_line(spark, parts):
    shapes = S.polygon_pieces(frame(spark, [("u", [dense(U, parts)])]))
    mouth = spark.createDataFrame([([(20000.0, 1674.0), (20000.0, 1900.0)],)], f"path {G.PATH}")
    assert L.nearest_routes(shapes, mouth).first().nearest_mapped_route_m == pytest.approx(337.0)
    inside = spark.createDataFrame([([(20000.0, 1100.0), (20000.0, 1200.0)],)], f"path {G.PATH}")
    assert L.nearest_routes(shapes, inside).first().nearest_mapped_route_m == 0.0


@pytest.mark.parametrize("parts", [1, 2, 200])
def test_box_across_the_line_is_covered(spark, parts):
    areas = S.polygon_pieces(frame(spark, [("w", [dense(WIDE, parts)]), ("u", [dense(U, parts)])], "code"))
    boxes = frame(spark, [("in", [dense(rectangle(19990, 1100, 20010, 1120), 1)]), ("half", [dense(rectangle(19990, 1200, 20010, 1230), 1)]), ("mouth", [dense(rectangle(19990, 1500, 20010, 1510), 1)])])
    got = {(r.node, r.code) for r in O.covered_by(S.polygon_pieces(boxes), "node", areas, "code").collect()}
    assert got == {("in", "w"), ("in", "u"), ("half", "u")}


def test_hole_and_slope_across_lines(spark):
    diamond = [(20000.0, 18500.0), (21500.0, 20000.0), (20000.0, 21500.0), (18500.0, 20000.0)]
    hole = [(19990.0, 19990.0), (19990.0, 20010.0), (20010.0, 20010.0), (20010.0, 19990.0), (19990.0, 19990.0)]
    rings = [("d", [dense(diamond, 150), hole])]
    pieces = S.polygon_pieces(frame(spark, rings), edge_cell=S.PIECE_CELL_M)
    assert pieces.count() == 4
    outline = S.outline_segments(pieces, ["node"])
    assert D.outline_area(outline, "node").first().area_m2 == pytest.approx(2 * 1500**2 - 400)
    length = outline.agg(F.sum(F.expr(G.edge_length("s")))).first()[0]
    assert length == pytest.approx(4 * 1500 * math.sqrt(2) + 80)
    square = S.polygon_pieces(frame(spark, [("s", [dense(rectangle(19000, 19000, 21000, 21000), 1)])], "code"))
    overlap = S.overlap_areas(pieces, square, "node", "code").first().overlap_m2
    assert overlap == pytest.approx(2000**2 - 4 * 500**2 / 2 - 400)


def test_edges_on_the_line_are_kept_once(spark):
    left, right = rectangle(19000, 1000, 20000, 1500), rectangle(20000, 1000, 21000, 1500)
    pieces = S.polygon_pieces(frame(spark, [("l", [dense(left, 1)]), ("r", [dense(right, 1)])]))
    sides = S.outline_segments(pieces, ["node"]).groupBy("node").agg(F.sum(F.expr(G.edge_length("s"))).alias("m")).collect()
    assert {r.node: r.m for r in sides} == {"l": 3000.0, "r": 3000.0}
    both = land(spark, [("l", [dense(left, 1)]), ("r", [dense(right, 1)])])
    site = D.form_sites(both).sites.collect()
    assert len(site) == 1 and site[0].area_ha == pytest.approx(100.0)


def test_interior_cells_are_covered(spark):
    pieces = S.polygon_pieces(frame(spark, [("big", [dense(rectangle(5000, 5000, 75000, 75000), 3)])], "code"))
    point = spark.createDataFrame([("p", [(50000.0, 50000.0)]), ("q", [(40000.0, 40000.0)]), ("out", [(80000.0, 40000.0)])], f"node string, path {G.PATH}")
    assert {r.node for r in O.points_in_areas(point, "node", pieces, "code").collect()} == {"p", "q"}
