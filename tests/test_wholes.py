"""Points of whole shapes need no pieces."""

from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.operators import labels as L
from strollgraph.operators import spatial as S


def drawings(spark):
    """A comb of many edges on a cell line, a triangle and a box with a hole."""
    comb = [(10.0 * i, 250.0 + (300.0 if i % 2 else 0.0)) for i in range(80)]
    comb = comb + [(790.0, 0.0), (0.0, 0.0), comb[0]]
    triangle = [(0.0, 0.0), (700.0, 100.0), (50.0, 600.0), (0.0, 0.0)]
    box = [(0.0, 0.0), (900.0, 0.0), (900.0, 900.0), (0.0, 900.0), (0.0, 0.0)]
    hole = [(100.0, 100.0), (500.0, 100.0), (500.0, 800.0), (100.0, 800.0), (100.0, 100.0)]
    return spark.createDataFrame([("c", [comb]), ("t", [triangle]), ("b", [box, hole])], f"node string, rings {G.RINGS}")


def test_points_without_pieces(spark, monkeypatch):
    drawn = drawings(spark)
    want = sorted(L.site_points(S.polygon_pieces(drawn)).collect())
    monkeypatch.setattr(S, "store", None)  # nothing is written
    wholes = S.polygon_wholes(drawn)
    assert wholes.count() == 3 and sorted(L.site_points(wholes).collect()) == want
    edges = drawn.select("node", F.expr(G.polygon_edges("rings")).alias("e"))
    held = wholes.join(edges, "node").select(F.expr(G.point_in_polygon("whole.inner.x", "whole.inner.y", "e")).alias("in"))
    assert all(r["in"] for r in held.collect())
