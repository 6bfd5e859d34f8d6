"""Queries on outlines with many vertices: every supplier has a U of 640 edges astride a grid line, some vertices repeated,
and a second drawing of the same U with eight edges.  The mouth of the U narrows with the nation, so answers have closed forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.lattice.registry import query
from strollgraph.operators import labels as L
from strollgraph.operators import overlay as O
from strollgraph.operators import sites as D
from strollgraph.operators import spatial as S
from strollgraph.session import cut

R6 = lambda c: F.round(c, 6).alias(c)

PARTS = 80
#: The U in metres about the middle of its mouth, the right arm the wider; ``a`` is half the width of the mouth and the height of its floor.
CORNERS = (("-1000", "0"), ("1200", "0"), ("1200", "1000"), ("a", "1000"), ("a", "a"), ("-a", "a"), ("-a", "1000"), ("-1000", "1000"))


def corners(data: DataFrame) -> DataFrame:
    """``k, cx, a, at``: key, middle, half width and corners of every supplier's U."""
    listed = ", ".join(G.point(f"cx + {x}", y) for x, y in CORNERS)
    # A row becomes hundreds of points: the few rows of a small file are dealt to all cores first.
    return data.repartition("s_suppkey").selectExpr("s_suppkey as k", "60000D * s_suppkey as cx", "300D + s_nationkey as a").withColumn("at", F.expr(f"array({listed})"))


def drawn(us: DataFrame, parts: int) -> DataFrame:
    """The U with ``parts`` edges a side as ``rings``; corners come twice where a side is divided."""
    spot = (
        "named_struct('x', p.x + (q.x - p.x) * j / {n}, 'y', p.y + (q.y - p.y) * j / {n})".format(n=parts)
    )
    side = f"transform(sequence(0, {parts} - 1), j -> {spot})"
    first = "array(p)" if parts > 1 else "slice(array(p), 1, 0)"
    sides = f"transform(at, (p, i) -> transform(array(at[(i + 1) % 8]), q -> concat({first}, {side}))[0])"
    return us.withColumn("rings", F.expr(f"transform(array(flatten({sides})), ring -> concat(ring, slice(ring, 1, 1)))"))


def shapes(x) -> DataFrame:
    """Pieces of the fine drawing with the supplier as node."""
    return S.polygon_pieces(cut(drawn(corners(x.table("supplier")), PARTS).select(F.col("k").alias("node"), "rings")))


def land(x, parts: int) -> DataFrame:
    key = F.concat(F.lit("u"), F.col("k").cast("string"))
    # A table of known size: the planner takes drawn rings for a few bytes and would broadcast them.
    return cut(drawn(corners(x.table("supplier")), parts).select(
        key.alias("component_id"), key.alias("source_id"), F.lit("").alias("name"), F.lit("{}").alias("source_attributes"), "rings"
    ))


@query("b10_outline_hash", "SELECT concat('u', s_suppkey) AS component_id, true AS same FROM supplier")
def _(x):
    """The hash of a shape does not depend on its vertices, cuts and repeated points."""
    hashes = []
    for parts in (PARTS, 1):
        made = D.form_sites(land(x, parts))
        hashes.append(made.membership.join(made.sites.select("site_id", "geometry_sha256"), "site_id"))
    fine, plain = hashes
    return fine.join(plain.withColumnRenamed("geometry_sha256", "plain"), "component_id").select(
        "component_id", (F.col("geometry_sha256") == F.col("plain")).alias("same")
    )


@query("b18_outline_measures", "SELECT s_suppkey AS node, 2200000.0 - 2.0 * (300 + s_nationkey) * (700 - s_nationkey) AS area_m2, 8400.0 - 2.0 * (300 + s_nationkey) AS outline_m FROM supplier")
def _(x):
    edges = S.outline_segments(shapes(x), ["node"])
    return edges.groupBy("node").agg(
        F.round(F.sum(F.expr(G.edge_cross("s"))) / 2, 3).alias("area_m2"), F.round(F.sum(F.expr(G.edge_length("s"))), 3).alias("outline_m")
    )


@query("b19_outline_points", "SELECT s_suppkey AS site_id, 60000.0 * s_suppkey + (1500 + s_nationkey) / 2.0 AS easting, 500.0 AS northing FROM supplier")
def _(x):
    """A point follows from the whole shape, so nothing is cut into pieces."""
    us = drawn(corners(x.table("supplier")), PARTS).select(F.col("k").alias("node"), "rings")
    return L.site_points(S.polygon_wholes(us)).select("site_id", R6("easting"), R6("northing"))


@query("c9_outline_distance", "SELECT s_suppkey AS site_id, 300.0 + s_nationkey AS nearest_mapped_route_m FROM supplier")
def _(x):
    """A route stands in the mouth of every U, on the line where the U is cut."""
    routes = corners(x.table("supplier")).select(F.expr(G.line_path("cx", "2 * a", "cx", "2 * a + 10")).alias("path"))
    return L.nearest_routes(shapes(x), routes).select("site_id", R6("nearest_mapped_route_m"))


@query(
    "b26_outline_cover",
    "SELECT s_suppkey AS node, s_suppkey AS code FROM supplier",
)
def _(x):
    """A box in the floor astride the cut is covered; one in the mouth and one across the rim are not."""
    us = corners(x.table("supplier"))
    boxes = [("cx - 10", "100", "cx + 10", "120"), ("cx - 10", "a + 50", "cx + 10", "a + 60"), ("cx + 1190", "10", "cx + 1210", "20")]
    placed = [us.select((F.col("k") + F.lit(i * 10**9)).alias("node"), F.expr(G.box_rings(*b)).alias("rings")) for i, b in enumerate(boxes)]
    small = S.polygon_pieces(placed[0].unionByName(placed[1]).unionByName(placed[2]))
    return O.covered_by(cut(small), "node", cut(shapes(x).withColumnRenamed("node", "code")), "code")


@query("d2_outline_areas", "SELECT concat('u', s_suppkey) AS component_id, round((2200000.0 - 2.0 * (300 + s_nationkey) * (700 - s_nationkey)) / 10000, 6) AS area_ha FROM supplier")
def _(x):
    made = D.form_sites(land(x, PARTS))
    return made.membership.join(made.sites, "site_id").select("component_id", R6("area_ha"))
