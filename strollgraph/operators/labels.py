"""Authority labels, coverage gaps, nearest routes, hints and representative points."""

from __future__ import annotations

from functools import reduce
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.functions import projection as R
from strollgraph.operators import spatial as S
from strollgraph.session import cut

BOUNDARY_CELL_M = 1000.0
NEAREST_LIMIT_M = 10000.0
FIRST_RADIUS_M = 50.0
NEAREST_CELL_M = 125.0


def overlay_areas(shapes: DataFrame, outline: DataFrame, boundaries: DataFrame, key: str = "site_id") -> DataFrame:
    """Overlap area of every site with every boundary: ``site_id, code, overlap_m2``."""
    pieces = S.polygon_pieces(boundaries.select("code", "rings"))
    return S.overlap_areas(
        shapes.select(F.col("node").alias(key), "edges", *S.BOUNDS),
        pieces,
        key,
        "code",
        BOUNDARY_CELL_M,
        S.segment_bounds(outline.select(key, "s")),
    )


def boundary_labels(overlaps: DataFrame, boundaries: DataFrame, prefix: str, plural: str) -> DataFrame:
    """Dominant boundary and ordered lists per site from overlap areas; ties go to the smaller code."""
    named = overlaps.join(boundaries.select("code", F.col("name").alias("label")), "code")
    ranked = named.groupBy("site_id").agg(
        F.array_sort(
            F.collect_list(F.struct((-F.round("overlap_m2", 6)).alias("rank"), "code", "label"))
        ).alias("all")
    )
    first = F.element_at("all", 1)
    return ranked.select(
        "site_id",
        first["code"].alias(f"{prefix}_code"),
        first["label"].alias(prefix),
        F.array_join("all.code", ";").alias(f"all_{prefix}_codes"),
        F.array_join("all.label", ";").alias(plural),
    )


def dominant_boundary(overlaps: DataFrame) -> DataFrame:
    """Largest overlap per site as an aggregate, so a busy site is reduced before the shuffle."""
    best = overlaps.groupBy("site_id").agg(
        F.min(F.struct((-F.round("overlap_m2", 6)).alias("rank"), "code")).alias("best")
    )
    return best.select("site_id", F.col("best.code").alias("code"), (-F.col("best.rank")).alias("overlap_m2"))


def add_labels(sites: DataFrame, county_labels: DataFrame, council_labels: DataFrame) -> DataFrame:
    """Join both label sets; a site without county takes its council's code and name."""
    joined = sites.join(county_labels, "site_id", "left").join(council_labels, "site_id", "left")
    text = [c for c in county_labels.columns + council_labels.columns if c != "site_id"]
    joined = joined.withColumns({c: F.coalesce(c, F.lit("")) for c in text})
    empty = F.col("county") == ""
    return joined.withColumns(
        {
            "county": F.when(empty, F.col("council")).otherwise(F.col("county")),
            "county_code": F.when(empty, F.col("council_code")).otherwise(F.col("county_code")),
        }
    )


def meets_polygon(shapes: DataFrame, polygons: DataFrame, keep: list[str], cell: float = BOUNDARY_CELL_M) -> DataFrame:
    """Sites that meet (even at a point) any polygon: ``node`` plus kept polygon columns."""
    pieces = S.polygon_pieces(polygons.select(*keep, "rings"))
    outline = S.outline_segments(shapes, ["node"]).drop("edge_no")
    forward = S.link_distance(S.near_pairs(outline, pieces, 0.0, cell), 0.0).select(
        F.col("a_node").alias("node"), *[F.col(f"b_{k}").alias(k) for k in keep]
    )
    # A polygon inside a component has no component edge in it; test its own outline too.
    back = S.link_distance(
        S.near_pairs(S.outline_segments(pieces, keep).drop("edge_no"), shapes.select("node", "edges", *S.BOUNDS), 0.0, cell),
        0.0,
    ).select(F.col("b_node").alias("node"), *[F.col(f"a_{k}").alias(k) for k in keep])
    return forward.unionByName(back).distinct()


def nearest_routes(shapes: DataFrame, routes: DataFrame, limit: float = NEAREST_LIMIT_M) -> DataFrame:
    """Straight-line distance from every site to the closest route of any tier: ``site_id, nearest_mapped_route_m``.

    The grid cells that routes run in stand for them first.  A site looks around in ever coarser cells until it meets an occupied one, which
    bounds its distance from above; the fine cells no further away than that bound it again.  The segments in the cells that this leaves are
    bounded by their boxes in plain arithmetic, and only those that can be the nearest are measured.  Sites with nothing within the last
    ring get NULL.
    """
    if limit < FIRST_RADIUS_M:
        return shapes.select("node").distinct().select(F.col("node").alias("site_id"), F.lit(None).cast("double").alias("nearest_mapped_route_m"))
    last = FIRST_RADIUS_M
    while last * 2 <= limit:
        last *= 2
    size = NEAREST_CELL_M
    levels = max(0, math.ceil(math.log2(last / size)))
    segments = cut(S.segment_bounds(S.cell_segments(S.path_segments(routes, []).select("s"), size)))
    occupied = cut(segments.select("_cx", "_cy").distinct())
    # The outline touches every side of the box of its real edges; a piece without such edges lies inside the site as a whole.
    kept = "if(exists(edges, e -> not e.drawn), filter(edges, e -> not e.drawn), edges)"
    sides = {f"_{side}{axis}": f"array_{side}(transform(kept, ke -> {end}(ke.{axis}0, ke.{axis}1)))" for axis in ("x", "y") for side, end in (("min", "least"), ("max", "greatest"))}
    box = "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in sides.items()) + ")"
    pieces = cut(
        shapes.select("node", "edges", *S.BOUNDS)
        .withColumns({"_piece": F.monotonically_increasing_id(), "_box": F.expr(G.let(kept, "kept", box))})
    ).select("node", "edges", *S.BOUNDS, "_piece", "_box.*")
    boxes = pieces.drop("edges")
    # Read from the table: shapes that are not stored would be cut up again only to name their sites.
    sites = pieces.select("node").distinct()

    def around(df: DataFrame, level: int, reach: str) -> DataFrame:
        """Cells of a level that come within ``reach`` of the box of a piece."""
        g = size * 2**level
        for axis in ("x", "y"):
            df = df.withColumn(f"_c{axis}", F.expr(f"explode({G.tile_range(f'{axis}min - {reach}', f'{axis}max + {reach}', g)})"))
        return df

    def furthest(x: str, y: str) -> str:
        """The outline is no further from a point than this (squared): it touches the nearer of two sides somewhere."""
        close = lambda a, v: f"least(abs({v} - _min{a}), abs({v} - _max{a}))"
        wide = lambda a, v: f"greatest(abs({v} - _min{a}), abs({v} - _max{a}))"
        return f"least(pow({close('x', x)}, 2) + pow({wide('y', y)}, 2), pow({close('y', y)}, 2) + pow({wide('x', x)}, 2))"

    def bound(g: str) -> Column:
        """No route point of a cell is further from the piece than this: way to its middle and half its diagonal."""
        return F.expr(f"sqrt({furthest(f'(_cx + 0.5D) * {g}', f'(_cy + 0.5D) * {g}')}) + {g} * 0.7072D")

    found: list[DataFrame] = []
    open_pieces = boxes
    for level in range(levels + 1):
        g = size * 2**level
        coarse = occupied.select(F.shiftright("_cx", level).alias("_cx"), F.shiftright("_cy", level).alias("_cy")).distinct()
        met = around(open_pieces, level, f"{g}D").join(coarse, ["_cx", "_cy"]).withColumn("_far", bound(f"{g}D"))
        hit = cut(met.groupBy("node").agg(F.min("_far").alias("_far")).withColumn("_level", F.lit(level)))
        found.append(hit)
        open_pieces = open_pieces.join(hit, "node", "left_anti")
        if open_pieces.isEmpty():
            break
    reach = cut(reduce(DataFrame.unionByName, found))
    gap = lambda axis, low, high: f"greatest({axis}min - {high}, {low} - {axis}max, 0D)"
    cell_gap2 = " + ".join(f"pow({gap(a, f'_c{a} * {size}D', f'(_c{a} + 1) * {size}D')}, 2)" for a in ("x", "y"))
    near: list[DataFrame] = []
    for level in range(len(found)):
        fine = occupied.select(F.shiftright("_cx", level).alias("_kx"), F.shiftright("_cy", level).alias("_ky"), "_cx", "_cy")
        wide = around(boxes.join(reach.where(F.col("_level") == level), "node"), level, "_far").withColumnsRenamed({"_cx": "_kx", "_cy": "_ky"})
        near.append(wide.join(fine, ["_kx", "_ky"]).where(f"{cell_gap2} <= _far * _far").select(
            "node", "_piece", "_cx", "_cy", F.expr(cell_gap2).alias("_gap2"), bound(f"{size}D").alias("_near")
        ))
    cells = cut(reduce(DataFrame.unionByName, near))
    closest = cells.groupBy("node").agg((F.min("_near") + 1e-6).alias("_near"))
    left = cells.drop("_near").join(closest, "node").where("_gap2 <= _near * _near").select("_piece", "_cx", "_cy")
    routed = segments.select("_cx", "_cy", "s", *[F.col(c).alias(f"_s{c}") for c in S.BOUNDS])
    low2 = " + ".join(f"pow({gap(a, f'_s{a}min', f'_s{a}max')}, 2)" for a in ("x", "y"))
    measured = cut(
        left.repartition("_cx", "_cy").join(boxes, "_piece").join(routed, ["_cx", "_cy"]).select(
            "node", "_piece", "s", F.expr(low2).alias("_low2"),
            F.expr(f"least({furthest('s.x0', 's.y0')}, {furthest('s.x1', 's.y1')})").alias("_high2"),
        )
    )
    best_high = measured.groupBy("node").agg((F.sqrt(F.min("_high2")) + 1e-6).alias("_high"))
    # A segment that runs in several cells comes once for each.
    candidates = measured.join(best_high, "node").where("_low2 <= _high * _high").groupBy("_piece", "s").agg(F.count("*").alias("_n"))
    pairs = candidates.select("_piece", F.col("s").alias("a_s")).repartition("_piece").join(
        pieces.select("_piece", F.col("node").alias("b_node"), F.col("edges").alias("b_edges")), "_piece"
    )
    best = S.link_distance(pairs, last).groupBy(F.col("b_node").alias("node")).agg(F.min("link.d2").alias("d2"))
    return sites.join(best, "node", "left").select(
        F.col("node").alias("site_id"), F.sqrt("d2").alias("nearest_mapped_route_m")
    )


def nearby_hints(shapes: DataFrame, hints: DataFrame, distance: float) -> DataFrame:
    """Hints whose bounding box meets the bounding box of a site grown by ``distance``.

    Only boxes are compared, and a site's box spans all its components.
    """
    boxes = shapes.groupBy("node").agg(
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax")
    )
    bounded = G.with_bounds(hints, "flatten(rings)").select("source_id", *S.BOUNDS)
    pairs = S.near_pairs(boxes, bounded, distance, BOUNDARY_CELL_M)
    return pairs.groupBy(F.col("a_node").alias("site_id")).agg(
        F.array_join(F.array_sort(F.collect_set("b_source_id")), ";").alias("unverified_common_ids")
    )


def site_points(shapes: DataFrame) -> DataFrame:
    """Representative point of a site, taken in its largest component, on the grid and in degrees."""
    best = shapes.groupBy("node").agg(
        F.max_by("whole.inner", F.struct("whole.area", -F.col("whole.xmin"), -F.col("whole.ymin"))).alias("p")
    )
    placed = best.select(F.col("node").alias("site_id"), "p").withColumn(
        "g", F.expr(R.grid_to_lonlat("p.x", "p.y"))
    )
    return placed.select(
        "site_id", F.col("p.x").alias("easting"), F.col("p.y").alias("northing"),
        F.col("g.x").alias("longitude"), F.col("g.y").alias("latitude"),
    )
