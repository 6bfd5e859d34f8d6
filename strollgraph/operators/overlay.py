"""Overlay operators built on covered stretches: line against area, clipping, coverage by buffers."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strollgraph.functions import geometry as G
from strollgraph.operators import spatial as S


def line_area_lengths(lines: DataFrame, key: str, areas: DataFrame, area_key: str) -> DataFrame:
    """Inside, boundary and outside length of every line against every area it meets with length.

    ``lines`` has ``key`` and ``path``; ``areas`` is a piece table and rows sharing ``area_key`` act as a union.
    """
    segments = S.path_segments(lines.select(key, "path"), [key])
    spans = S.covered_spans(segments, areas.select(area_key, "edges", *S.BOUNDS))
    measured = S.union_measures(
        spans,
        [f"a_{key}", "a_edge_no", "a_s", f"b_{area_key}"],
        {"l": F.col("is_left"), "r": ~F.col("is_left"), "u": F.lit(True)},
    )
    length = F.expr(G.edge_length("a_s"))
    sums = measured.groupBy(F.col(f"a_{key}").alias(key), F.col(f"b_{area_key}").alias(area_key)).agg(
        F.sum((F.col("l") + F.col("r") - F.col("u")) * length).alias("inside_m"),
        F.sum((2 * F.col("u") - F.col("l") - F.col("r")) * length).alias("boundary_m"),
        F.sum(F.col("u") * length).alias("shared_m"),
    )
    total = lines.select(key, F.expr(G.path_length("path")).alias("length_m"))
    return sums.join(total, key).select(
        key, area_key, "inside_m", "boundary_m", (F.col("length_m") - F.col("shared_m")).alias("outside_m")
    )


def merged_spans(spans: DataFrame, group: list[str]) -> DataFrame:
    """Union of stretches per group as disjoint stretches ``t0, t1`` (gaps and islands)."""
    order = Window.partitionBy(*group).orderBy("t0", "t1")
    before = F.max("t1").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("t0") - before > 1e-12), 1).otherwise(0)
    marked = spans.select(*group, "t0", "t1", opens.alias("_open"))
    numbered = marked.withColumn("_island", F.sum("_open").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*group, "_island").agg(F.min("t0").alias("t0"), F.max("t1").alias("t1")).drop("_island")


def within_buffers(segments: DataFrame, key: list[str], edges: DataFrame, radius: float, on: str | None = None) -> DataFrame:
    """Share of every segment that lies within ``radius`` of any of the given edges.

    ``segments`` holds ``key``, ``s`` and bounds; the result has ``key``, ``s`` and ``covered`` from 0 to 1
    for the segments with some cover.  ``on`` restricts pairs to equal values of a column.
    """
    same = None if on is None else F.col(f"a_{on}") == F.col(f"b_{on}")
    pairs = S.near_pairs(segments, edges, radius, max(S.DEFAULT_CELL_M, radius), same)
    pairs = pairs.withColumn("p", G.keep(G.capsule_span("a_s", "b_s", radius), "c", "c is not null"))
    rows = pairs.select(
        *[F.col(f"a_{k}").alias(k) for k in key], F.col("a_s").alias("s"), "p.t0", "p.t1"
    )
    return S.union_measures(rows, [*key, "s"], {"covered": F.lit(True)})


def points_in_areas(points: DataFrame, key: str, areas: DataFrame, area_key: str, condition: Column | None = None) -> DataFrame:
    """Points covered by areas, outline included: ``key, area_key``; points come as one-vertex paths."""
    as_segment = points.select(key, F.expr(G.segment("path[0].x", "path[0].y", "path[0].x", "path[0].y")).alias("s"))
    pairs = S.near_pairs(S.segment_bounds(as_segment), areas.select(area_key, "edges", *S.BOUNDS), condition=condition)
    hit = S.link_distance(pairs, 0.0)
    return hit.select(F.col(f"a_{key}").alias(key), F.col(f"b_{area_key}").alias(area_key)).distinct()


def covered_by(shapes: DataFrame, key: str, areas: DataFrame, area_key: str) -> DataFrame:
    """Polygons lying wholly in an area: no edge leaves it and no hole of it lies inside."""
    edges = S.outline_segments(shapes, [key]).drop("edge_no")
    spans = S.covered_spans(edges, areas.select(area_key, "edges", *S.BOUNDS))
    measured = S.union_measures(spans, [f"a_{key}", "a_s", f"b_{area_key}"], {"l": F.col("is_left")})
    inside = (
        measured.where(F.col("l") >= 1 - 1e-9)
        .groupBy(F.col(f"a_{key}").alias(key), F.col(f"b_{area_key}").alias(area_key))
        .agg(F.count("*").alias("n"))
    )
    total = shapes.groupBy(key).agg(F.sum(F.expr(f"size({G.outline_edges('edges')})")).alias("edges_n"))
    whole = inside.join(total, key).where(F.col("n") == F.col("edges_n")).select(key, area_key)
    # A hole of the area strictly inside the polygon shows as area edges covered on both sides.
    reverse = S.covered_spans(
        S.outline_segments(areas, [area_key]).drop("edge_no"), shapes.select(key, "edges", *S.BOUNDS)
    )
    holes = (
        S.union_measures(
            reverse,
            [f"a_{area_key}", "a_s", f"b_{key}"],
            {"l": F.col("is_left"), "r": ~F.col("is_left"), "u": F.lit(True)},
        )
        .where(F.col("l") + F.col("r") - F.col("u") > 1e-9)
        .select(F.col(f"b_{key}").alias(key), F.col(f"a_{area_key}").alias(area_key))
        .distinct()
    )
    return whole.join(holes, [key, area_key], "left_anti")


def lines_outside(lines: DataFrame, key: str, areas: DataFrame) -> DataFrame:
    """Lines minus areas: the kept parts of every line as paths: ``key, part_no, path``."""
    segments = S.path_segments(lines.select(key, "path"), [key])
    spans = S.covered_spans(segments, areas.select("edges", *S.BOUNDS)).select(
        F.col(f"a_{key}").alias(key), F.col("a_edge_no").alias("edge_no"), "t0", "t1"
    )
    free = S.uncovered_spans(spans, segments.select(key, "edge_no", "s"), [key, "edge_no"])
    order = Window.partitionBy(key).orderBy("edge_no", "t0")
    # A stretch goes on the one before when that ended at the vertex where this one starts.
    goes_on = (
        (F.lag("edge_no").over(order) == F.col("edge_no") - 1)
        & (F.lag("t1").over(order) == 1)
        & (F.col("t0") == 0)
    )
    parts = free.withColumn("_new", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).withColumn(
        "part_no", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1
    )
    cut = parts.select(key, "part_no", "edge_no", "t0", F.expr(G.part_of("s", "t0", "t1")).alias("s"))
    listed = cut.groupBy(key, "part_no").agg(F.array_sort(F.collect_list(F.struct("edge_no", "t0", "s"))).alias("l"))
    first, rest = G.point("l[0].s.x0", "l[0].s.y0"), "transform(l, k -> " + G.point("k.s.x1", "k.s.y1") + ")"
    return listed.select(key, "part_no", F.expr(f"concat(array({first}), {rest})").alias("path"))


def clip_polygons(polygons: DataFrame, key: str, mask: DataFrame) -> DataFrame:
    """Polygons cut to a mask: ``key, part_no, rings``; polygons wholly inside pass unchanged.

    The outline of the result is the polygon edges with the mask on their inner side plus the mask
    edges strictly inside the polygon.  Only polygons that the mask cuts are stitched into rings,
    each from its own few edges.
    """
    shapes = S.whole_polygons(polygons.select(key, "rings"))
    pieces = S.polygon_pieces(mask.select("rings"))
    spans = S.covered_spans(
        S.outline_segments(shapes, [key]).drop("edge_no"), pieces.select("edges", *S.BOUNDS), 1000.0
    ).where("is_left")
    own = merged_spans(spans.select(F.col(f"a_{key}").alias(key), F.col("a_s").alias("s"), "t0", "t1"), [key, "s"])
    mask_edges = S.segment_bounds(mask.select(F.expr(f"explode({G.polygon_edges('rings')}) as s")))
    both = (
        "flatten(transform(left, a -> filter(transform(right, b -> named_struct("
        "'t0', greatest(a.t0, b.t0), 't1', least(a.t1, b.t1))), c -> c.t1 - c.t0 > 1e-12D)))"
    )
    inner = G.with_cover(
        S.near_pairs(mask_edges, shapes.select(key, "edges", *S.BOUNDS), 0.0, 1000.0), "a_s", "b_edges"
    ).select(F.col(f"b_{key}").alias(key), F.col("a_s").alias("s"), F.expr(f"inline({both})"))
    whole = (
        own.where("t0 <= 1e-12 and t1 >= 1 - 1e-12")
        .groupBy(key)
        .agg(F.count("*").alias("n"))
        .join(shapes.select(key, F.size("edges").alias("edges_n")), key)
        .where("n = edges_n")
        .select(key)
        .join(inner.select(key), key, "left_anti")
    )
    unchanged = polygons.join(whole, key, "left_semi").select(key, F.lit(0).alias("part_no"), "rings")
    part = F.expr(G.part_of("s", "t0", "t1"))
    cut = (
        own.unionByName(inner)
        .join(whole, key, "left_anti")
        .select(key, part.alias("s"))
        .groupBy(key)
        .agg(F.collect_list("s").alias("edges"))
    )
    stitched = cut.select(key, F.posexplode(stitch_rings("edges")).alias("part_no", "rings"))
    return unchanged.unionByName(stitched)


VERTEX = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
POLYGONS = T.ArrayType(T.ArrayType(T.ArrayType(VERTEX)))


@F.pandas_udf(POLYGONS)
def stitch_rings(edges: pd.Series) -> pd.Series:
    """Join directed edges (interior on the left) into polygons with their holes, in sorted order."""
    return edges.map(_polygons)


def _polygons(edges) -> list:
    at = lambda x, y: (round(x, 6) + 0.0, round(y, 6) + 0.0)
    leaving: dict[tuple, list[tuple]] = {}
    for e in edges:
        a, b = at(e["x0"], e["y0"]), at(e["x1"], e["y1"])
        if a != b:
            leaving.setdefault(a, []).append(b)
    rings = []
    while leaving:
        start = min(leaving)
        ring = [start]
        while True:
            here = ring[-1]
            ways = leaving[here]
            # At a shared corner take the sharpest left turn, so touching parts stay apart.
            if len(ways) > 1 and len(ring) > 1:
                back = math.atan2(ring[-2][1] - here[1], ring[-2][0] - here[0])
                turn = lambda p: (back - math.atan2(p[1] - here[1], p[0] - here[0])) % (2 * math.pi) or 2 * math.pi
                after = min(ways, key=turn)
            else:
                after = ways[0]
            ways.remove(after)
            if not ways:
                del leaving[here]
            ring.append(after)
            if after == start or after not in leaving:
                break
        if ring[0] == ring[-1] and len(ring) >= 4:
            rings.append(ring)
    area = lambda r: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:])) / 2
    outer = sorted((r for r in rings if area(r) > 1e-9), key=lambda r: (min(r), area(r)))
    polygons = [[r] for r in outer]

    def holds(ring, p):
        hits = [
            p[0] < a[0] + (p[1] - a[1]) / (b[1] - a[1]) * (b[0] - a[0])
            for a, b in zip(ring, ring[1:])
            if (a[1] > p[1]) != (b[1] > p[1])
        ]
        return sum(hits) % 2 == 1

    for hole in (r for r in rings if area(r) < -1e-9):
        homes = [p for p in polygons if holds(p[0], ((hole[0][0] + hole[1][0]) / 2, (hole[0][1] + hole[1][1]) / 2))]
        if homes:
            min(homes, key=lambda p: area(p[0])).append(hole)
    return [[[{"x": x, "y": y} for x, y in ring] for ring in p] for p in polygons]
