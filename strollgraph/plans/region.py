"""Regional runs: study areas, context selection, cut edges and the expansion loop."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.operators import network as N
from strollgraph.operators import overlay as O
from strollgraph.operators import sites as D
from strollgraph.operators import spatial as S
from strollgraph.operators.review import SETTLED
from strollgraph.session import cut

EDGE_SLACK_M = 5.0
CONTEXT_CELL_M = 1000.0
# Dissolved study areas are dealt to cells of this size.
STUDY_CELL_M = 5000.0
# Width of the certainty grid: this many cells per search radius.
SURE_STEPS = 4


def authority_table(counties: DataFrame, councils: DataFrame) -> DataFrame:
    """Codes and names of both layers, each code once (the county layer wins)."""
    rows = counties.select("code", "name", F.lit(0).alias("layer")).unionByName(
        councils.select("code", "name", F.lit(1).alias("layer"))
    )
    return rows.groupBy("code").agg(F.min_by("name", "layer").alias("name"))


def resolve_authorities(authorities: DataFrame, requested: DataFrame) -> DataFrame:
    """Match requested codes or names (any case): ``item, code, name, matches``.

    ``matches`` other than 1 means unknown or ambiguous.
    """
    keys = authorities.select(
        "code", "name", F.explode(F.array_distinct(F.array("code", F.concat(F.lit("name:"), F.lower("name"))))).alias("key")
    )
    asked = requested.select(
        "item", F.explode(F.array("item", F.concat(F.lit("name:"), F.lower("item")))).alias("key")
    ).distinct()
    found = asked.join(keys, "key").groupBy("item").agg(
        F.min("code").alias("code"), F.min_by("name", "code").alias("name"), F.count_distinct("code").alias("matches")
    )
    return requested.select("item").distinct().join(found, "item", "left").withColumn(
        "matches", F.coalesce("matches", F.lit(0))
    )


def require_resolved(resolved: DataFrame) -> DataFrame:
    bad = resolved.where("matches <> 1").select("item").take(1)
    if bad:
        raise ValueError(f"Unknown or ambiguous authority '{bad[0][0]}'; use its code")
    return resolved


def check_buffers(study_m: float = 0.0, context_m: float = 20000.0, maximum_m: float = 80000.0) -> None:
    if not math.isfinite(study_m) or study_m < 0:
        raise ValueError("The study buffer must be finite and not negative")
    if context_m <= 0 or maximum_m < context_m:
        raise ValueError("Context buffers must be positive and the maximum not below the first")


def check_box(west: float, south: float, east: float, north: float) -> tuple[float, float, float, float]:
    if not (west < east and south < north):
        raise ValueError("A box needs west < east and south < north")
    return west, south, east, north


@dataclass(frozen=True)
class StudyAreas:
    """Study areas of one or several authorities, each dissolved and cut to its box.

    ``members``: ``study, code, name`` of the authorities; ``outline``: ``code, s`` and bounds, oriented with the area on the left;
    ``pieces``: ``code, edges`` and bounds, which the selections below take in place of polygons; ``areas``: ``code, authorities, area_m2``
    and bounds.
    """

    members: DataFrame
    outline: DataFrame
    pieces: DataFrame
    areas: DataFrame


def study_pieces(studies: DataFrame) -> DataFrame:
    """Pieces ``code, edges`` and bounds of studies given as polygons (``code, rings``) or as pieces."""
    pieces = studies if "edges" in studies.columns else S.polygon_pieces(studies.select("code", "rings"))
    return pieces.select("code", "edges", *S.BOUNDS)


def dissolved(polygons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pieces of all parts of a code, and the outline of their union: ``code, s``.  ``polygons``: ``code, part, rings``."""
    named = polygons.select("code", F.to_json(F.struct("code", "part")).alias("component_id"), "rings")
    pieces = cut(S.polygon_pieces(named).select("code", "component_id", "edges", *S.BOUNDS))
    same = (F.col("a_code") == F.col("b_code")) & (F.col("a_component_id") != F.col("b_component_id"))
    spans = S.covered_spans(S.outline_segments(pieces, ["code", "component_id"]).drop("edge_no"), pieces, CONTEXT_CELL_M, same)
    hidden = spans.select(
        F.col("a_component_id").alias("component_id"), F.col("a_s").alias("s"), F.col("b_component_id").alias("other_id"), "is_left", "t0", "t1"
    )
    free = D.union_outline(pieces, hidden).select("s", F.get_json_object("component_id", "$.code").alias("code"))
    return pieces.drop("component_id"), free.select("code", "s")


def cut_to_boxes(outline: DataFrame, pieces: DataFrame, boxes: DataFrame) -> DataFrame:
    """Outline ``code, s`` of areas cut to the box of their code (``code, rings``); codes without a box stay whole.

    What remains is every stretch of the outline with the box on its inner side, and every stretch of the box with the area on both
    sides.  Where both run along each other the first rule alone decides.
    """
    windows = S.whole_polygons(boxes.select("code", "rings")).select("code", "edges", *S.BOUNDS)
    same = F.col("a_code") == F.col("b_code")
    key = [F.col("a_code").alias("code"), F.col("a_s").alias("s"), "t0", "t1"]
    part = F.expr(G.part_of("s", "t0", "t1")).alias("s")
    bounded = S.segment_bounds(outline.join(boxes.select("code"), "code", "left_semi"))
    own = S.covered_spans(bounded, windows, CONTEXT_CELL_M, same).where("is_left").select(*key)
    rim = S.covered_spans(S.outline_segments(windows, ["code"]).drop("edge_no"), pieces, CONTEXT_CELL_M, same)
    left, right = (O.merged_spans(rim.where(F.col("is_left") == side).select(*key), ["code", "s"]) for side in (True, False))
    both = left.alias("l").join(right.alias("r"), ["code", "s"]).select(
        "code", "s", F.greatest("l.t0", "r.t0").alias("t0"), F.least("l.t1", "r.t1").alias("t1")
    ).where("t1 - t0 > 1e-12")
    whole = outline.join(boxes.select("code"), "code", "left_anti").select("code", "s")
    return whole.unionByName(own.select("code", part)).unionByName(both.select("code", part))


def study_areas(layers: DataFrame, requested: DataFrame, boxes: DataFrame | None = None) -> StudyAreas:
    """Study areas from the polygons of authorities.

    ``layers``: ``code, name, rings``, both layers of authorities; a code in both counts once.  ``requested``: ``study, item`` with a code or a
    name (any case) per row.  ``boxes``: ``study, x0, y0, x1, y1``; a study without requests is its box, others are cut to it.
    Unknown and ambiguous items, boxes without extent and studies that come out empty raise ValueError.  Corners are rounded to a micrometre.
    """
    resolved = cut(require_resolved(resolve_authorities(layers.groupBy("code").agg(F.min("name").alias("name")), requested)))
    members = cut(requested.join(resolved, "item").select("study", "code", "name").distinct())
    polygons = members.select("study", "code").join(layers.select("code", "rings").distinct(), "code").select(
        F.col("study").alias("code"), F.struct("code", F.xxhash64("rings")).alias("part"), "rings"
    )
    windows = None
    if boxes is not None:
        if not boxes.where("not (x0 < x1 and y0 < y1)").isEmpty():
            raise ValueError("A box needs west < east and south < north")
        windows = boxes.select(F.col("study").alias("code"), F.expr(G.box_rings(*(f"cast({c} as double)" for c in ("x0", "y0", "x1", "y1")))).alias("rings"))
        alone = windows.join(members.select(F.col("study").alias("code")), "code", "left_anti")
        none = F.struct(F.lit("").alias("code"), F.lit(0).cast("bigint"))
        polygons = polygons.unionByName(alone.select("code", none.alias("part"), "rings"))
    pieces, outline = dissolved(polygons)
    if windows is not None:
        outline = cut_to_boxes(cut(outline), pieces, windows)
    at = ", ".join(f"'{c}', round(s.{c}, 6) + 0D" for c in ("x0", "y0", "x1", "y1"))
    outline = cut(S.segment_bounds(outline.select("code", F.expr(f"named_struct({at})").alias("s")).where("s.x0 <> s.x1 or s.y0 <> s.y1")))
    own = S.edge_cells(outline.select("code", F.col("s").alias("e")), ["code"], STUDY_CELL_M)
    ends = "flatten(transform(edges, be -> array(named_struct('x', be.x0, 'y', be.y0), named_struct('x', be.x1, 'y', be.y1))))"
    measured = outline.groupBy("code").agg(
        (F.sum(F.expr(G.edge_cross("s"))) / 2).alias("area_m2"), F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
    )
    named = polygons.select("code").distinct().join(members.groupBy(F.col("study").alias("code")).agg(F.count("*").alias("authorities")), "code", "left")
    areas = cut(named.join(measured, "code", "left").na.fill(0, ["authorities"]).na.fill(0.0, ["area_m2"]))
    empty = areas.where("area_m2 <= 1e-6").select("code").take(1)
    if empty:
        raise ValueError(f"Study area '{empty[0][0]}' is empty")
    return StudyAreas(members, outline, cut(G.with_bounds(own, ends)), areas)


def limited_by_source(
    areas: StudyAreas, extents: DataFrame, source: DataFrame, context_m: float, study_buffer_m: float = 0.0
) -> DataFrame:
    """``code, limited``: whether the context of a study reaches beyond the source (``rings``, one row per extract).

    A context lies within the source where its study does and no outline of the source comes nearer to the study than both buffers, or to
    a selected site (``extents``, pieces) than the context buffer; so neither the context nor its buffer is ever built as a shape.
    """
    check_buffers(study_buffer_m, context_m, max(context_m, 80000.0))
    pieces, outline = dissolved(source.distinct().select(F.lit("source").alias("code"), F.xxhash64("rings").alias("part"), "rings"))
    rim = cut(S.segment_bounds(outline.select(F.col("code").alias("source"), "s")))
    parts = cut(S.edge_cells(rim.select("source", F.col("s").alias("e")), ["source"], STUDY_CELL_M))
    ends = "flatten(transform(edges, be -> array(named_struct('x', be.x0, 'y', be.y0), named_struct('x', be.x1, 'y', be.y1))))"
    inside = S.overlap_areas(areas.pieces, G.with_bounds(parts, ends), "code", "source", CONTEXT_CELL_M, areas.outline).select("code", "overlap_m2")
    near = near_shapes(rim, "source", areas.pieces, context_m + study_buffer_m, strict=True).select("code").unionByName(
        near_shapes(rim, "source", extents, context_m, strict=True).select("code")
    ).distinct().withColumn("near", F.lit(True))
    return areas.areas.join(inside, "code", "left").join(near, "code", "left").select(
        "code", F.expr("near is not null or coalesce(overlap_m2, 0D) < area_m2 * (1 - 1e-9D)").alias("limited")
    )


def _offsets(reach: float) -> str:
    """Cell offsets whose whole cells lie within ``reach`` cell widths of each other."""
    steps = range(-int(reach), int(reach) + 1)
    near = [(i, j) for i in steps for j in steps if math.hypot(abs(i) + 1, abs(j) + 1) <= reach]
    return "array(" + ", ".join(f"named_struct('i', {i}L, 'j', {j}L)" for i, j in near) + ")"


def sure_cells(extents: DataFrame, radius_m: float) -> tuple[DataFrame, float]:
    """Cells lying wholly within ``radius_m`` of the outline of an extent: ``code, cx, cy``, and their size.

    Points along the outlines are reduced to distinct cells before they spread to their
    surroundings, so the work follows the area covered and not the number of shapes.
    """
    size = radius_m / SURE_STEPS
    edges = S.outline_segments(extents, ["code"]).select("code", F.col("s").alias("e"))
    steps = f"cast(ceil({G.edge_length('e')} / {size}D) as int)"
    at = "named_struct('x', e.x0 + (e.x1 - e.x0) * k / greatest(n, 1), 'y', e.y0 + (e.y1 - e.y0) * k / greatest(n, 1))"
    cells = (
        edges.selectExpr("code", "e", f"{steps} as n")
        .selectExpr("code", f"explode(transform(sequence(0, n), k -> {at})) as p")
        .selectExpr("code", f"{G.tile_index('p.x', size)} as ox", f"{G.tile_index('p.y', size)} as oy")
        .distinct()
    )
    spread = cells.selectExpr("code", "ox", "oy", f"explode({_offsets(SURE_STEPS)}) as d")
    return spread.selectExpr("code", "ox + d.i as cx", "oy + d.j as cy").distinct(), size


def _end_cells(segments: DataFrame, key: str, size: float) -> DataFrame:
    ends = "explode(array(named_struct('x', s.x0, 'y', s.y0), named_struct('x', s.x1, 'y', s.y1))) as p"
    return segments.selectExpr(key, ends).selectExpr(
        key, f"{G.tile_index('p.x', size)} as cx", f"{G.tile_index('p.y', size)} as cy"
    ).distinct()


def near_shapes(segments: DataFrame, key: str, studies: DataFrame, distance: float, strict: bool = False) -> DataFrame:
    """Pairs of ``key`` and study ``code`` within ``distance``; both sides may hold many pieces.

    Three steps, each on what the ones before left open: what meets the area itself, what has an
    end in a cell surely within reach, and an exact test of the rest against the rim.
    """
    pieces = studies.select("code", "edges", *S.BOUNDS)
    pair = [F.col(f"a_{key}").alias(key), F.col("b_code").alias("code")]
    meets = S.link_distance(S.near_pairs(segments, pieces, 0.0, CONTEXT_CELL_M), 0.0).select(*pair).distinct()
    cells, size = sure_cells(pieces, distance * (1 - 1e-9))
    sure = _end_cells(segments, key, size).join(cells, ["cx", "cy"]).select(key, "code").distinct()
    done = cut(meets.unionByName(sure).distinct())
    # Studies whose grown box a segment meets, without those already settled.
    boxes = pieces.groupBy("code").agg(
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax")
    )
    wide = S.near_pairs(segments.select(key, "s", *S.BOUNDS), boxes, distance, max(CONTEXT_CELL_M, distance))
    rest = wide.select(
        F.col(f"a_{key}").alias(key), F.col("b_code").alias("code"), F.col("a_s").alias("s"),
        *[F.col(f"a_{c}").alias(c) for c in S.BOUNDS],
    ).join(done, [key, "code"], "left_anti")
    linked = S.link_distance(
        S.near_pairs(rest, pieces, distance, max(CONTEXT_CELL_M, distance / 4), F.col("a_code") == F.col("b_code")),
        distance,
    )
    if strict:
        linked = linked.where(F.col("link.d2") < float(distance) ** 2)
    return done.unionByName(linked.select(*pair).distinct())


def select_sites(shapes: DataFrame, outline: DataFrame, studies: DataFrame, study_buffer_m: float = 0.0) -> DataFrame:
    """Sites of every study area: ``code, site_id, in_core``.

    A site belongs to a study with positive shared area.  With a study buffer, land closer to the
    core than the buffer shares area with the grown study, so a distance test replaces the buffer shape.
    """
    check_buffers(study_buffer_m)
    pieces = study_pieces(studies)
    core = S.overlap_areas(
        shapes.select(F.col("node").alias("site_id"), "edges", *S.BOUNDS), pieces, "site_id", "code",
        CONTEXT_CELL_M, S.segment_bounds(outline.select("site_id", "s")),
    ).select("code", "site_id", F.lit(True).alias("in_core"))
    if study_buffer_m == 0:
        return core
    edges = S.outline_segments(shapes.select(F.col("node").alias("site_id"), "edges"), ["site_id"]).drop("edge_no")
    near = near_shapes(edges, "site_id", pieces, study_buffer_m, strict=True)
    return (
        near.withColumn("in_core", F.lit(False)).unionByName(core, allowMissingColumns=True)
        .groupBy("code", "site_id").agg(F.bool_or("in_core").alias("in_core"))
    )


def context_extents(studies: DataFrame, shapes: DataFrame, selected: DataFrame) -> DataFrame:
    """Shapes whose surroundings form the context: the study itself (``own``) and its selected sites, as pieces."""
    own = study_pieces(studies).withColumn("own", F.lit(True))
    sites = shapes.join(selected.select("code", F.col("site_id").alias("node")), "node")
    return own.unionByName(sites.select("code", "edges", *S.BOUNDS, F.lit(False).alias("own")))


def grown(extents: DataFrame, radius_m: float, study_buffer_m: float) -> list[tuple[DataFrame, float]]:
    """Extents with the distance their context reaches: the study itself goes further by the study buffer."""
    if study_buffer_m == 0:
        return [(extents, radius_m)]
    return [(extents.where("own"), radius_m + study_buffer_m), (extents.where("not own"), radius_m)]


def near_context(segments: DataFrame, key: str, extents: DataFrame, buffer_m: float, study_buffer_m: float = 0.0) -> DataFrame:
    """Pairs of ``key`` and ``code`` of all shapes that meet a context."""
    parts = [near_shapes(segments, key, shapes, reach) for shapes, reach in grown(extents, buffer_m, study_buffer_m)]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]).distinct()


def context_routes(routes: DataFrame, extents: DataFrame, buffer_m: float, study_buffer_m: float = 0.0) -> DataFrame:
    """Routes that meet the context of a study: ``code, route_index``."""
    return near_context(S.path_segments(routes, ["route_index"]).drop("edge_no"), "route_index", extents, buffer_m, study_buffer_m)


def _not_surely_within(segments: DataFrame, key: str, extents: DataFrame, radius_m: float) -> DataFrame:
    """Segments with some cell not surely within reach; only these need an exact test."""
    cells, size = sure_cells(extents, radius_m)
    spread = segments.select("code", key, "s", *S.BOUNDS).selectExpr(
        "code", key, "s", f"explode({G.tile_range('xmin', 'xmax', size)}) as cx", "ymin", "ymax"
    ).selectExpr("code", key, "s", "cx", f"explode({G.tile_range('ymin', 'ymax', size)}) as cy")
    open_segments = spread.join(cells, ["code", "cx", "cy"], "left_anti").select("code", key, "s").distinct()
    return cut(S.segment_bounds(open_segments))


def beyond_context(segments: DataFrame, key: str, extents: DataFrame, radius_m: float, study_buffer_m: float = 0.0) -> DataFrame:
    """Pairs ``code, key`` with some part further than ``radius_m`` from the extents (and the study buffer from the study).

    ``segments``: ``key, code, s`` and bounds of the pairs to test.
    """
    own = F.col("a_code") == F.col("b_code")
    reaches = grown(extents, radius_m, study_buffer_m)
    for shapes, reach in reaches:
        if reach > 0:
            segments = _not_surely_within(segments, key, shapes, reach)
    inside = S.covered_spans(segments, extents, CONTEXT_CELL_M, own).select(
        F.col("a_code").alias("code"), F.col(f"a_{key}").alias(key), F.col("a_s").alias("s"), "t0", "t1"
    )
    covered = inside
    for shapes, reach in reaches:
        edges = S.outline_segments(shapes, ["code"]).drop("edge_no")
        pairs = S.near_pairs(segments, edges, reach, max(CONTEXT_CELL_M, reach), own).withColumn(
            "p", G.keep(G.capsule_span("a_s", "b_s", reach), "c", "c is not null")
        )
        covered = covered.unionByName(pairs.select(
            F.col("a_code").alias("code"), F.col(f"a_{key}").alias(key), F.col("a_s").alias("s"), "p.t0", "p.t1"
        ))
    full = S.union_measures(covered, ["code", key, "s"], {"u": F.lit(True)}).where("u >= 1 - 1e-9")
    return segments.join(full, ["code", key, "s"], "left_anti").select("code", key).distinct()


def cut_routes(routes: DataFrame, selected: DataFrame, extents: DataFrame, buffer_m: float, study_buffer_m: float = 0.0) -> DataFrame:
    """Context routes that come within 5 m of the context edge: ``code, route_index``."""
    segments = S.path_segments(routes, ["route_index"]).drop("edge_no").join(selected, "route_index")
    return beyond_context(segments, "route_index", extents, max(buffer_m - EDGE_SLACK_M, 0.0), study_buffer_m)


def cut_sites(shapes: DataFrame, pairs: DataFrame, extents: DataFrame, buffer_m: float, study_buffer_m: float = 0.0) -> DataFrame:
    """Context sites or hints not covered by the context: ``code, node``; ``pairs`` has ``code, node``."""
    segments = S.outline_segments(shapes.select("node", "edges"), ["node"]).drop("edge_no").join(pairs, "node")
    return beyond_context(segments, "node", extents, buffer_m, study_buffer_m)


def boundary_nodes(routes_cut: DataFrame, sites_cut: DataFrame) -> DataFrame:
    """Graph nodes touching the context edge."""
    return routes_cut.select(N.route_node("route_index").alias("node")).unionByName(sites_cut.select("node")).distinct()


def prepare_region(inputs, study: DataFrame, buffer_m: float, study_buffer_m: float = 0.0):
    """Inputs of a run over one study area (``code, rings`` or pieces of ``study_areas``) and its context of ``buffer_m``.

    Takes and returns ``analyse.Inputs``.  Sites, hints, barriers and routes of the context are kept whole; what its edge cuts
    becomes ``boundary_nodes``.  Every table that later steps read more than once is written, so
    that a run over the result does not select the context again.
    """
    from dataclasses import replace

    from strollgraph.plans.analyse import walkable

    catalogue = inputs.catalogue
    shapes = cut(D.site_shapes(catalogue.membership, catalogue.components).select("node", "edges", *S.BOUNDS))
    chosen = cut(select_sites(shapes, catalogue.outline, study, study_buffer_m))
    extents = cut(context_extents(study, shapes, chosen))
    reach = (extents, buffer_m, study_buffer_m)
    route_pairs = cut(context_routes(inputs.routes, *reach))
    outline = lambda df: S.outline_segments(df, ["node"]).drop("edge_no")
    site_pairs = cut(near_context(outline(shapes), "node", *reach))
    own = chosen.select(F.col("site_id").alias("node"))
    near_sites = cut(site_pairs.select("node").unionByName(own).distinct().withColumnRenamed("node", "site_id"))
    here = lambda df: df.join(near_sites, "site_id", "left_semi")
    membership = cut(here(catalogue.membership))
    local = D.Catalogue(
        sites=cut(here(catalogue.sites)), membership=membership, outline=cut(here(catalogue.outline)),
        components=cut(catalogue.components.join(membership.select("component_id"), "component_id", "left_semi")),
    )
    first = G.segment("path[0].x", "path[0].y", "path[0].x", "path[0].y")
    spots = S.segment_bounds(inputs.barriers.select("node_id", F.expr(first).alias("s")))
    lines = S.path_segments(inputs.barriers, ["node_id"]).drop("edge_no")
    near_barriers = near_context(spots.unionByName(lines), "node_id", *reach).select("node_id").distinct()
    routes = cut(inputs.routes.join(route_pairs.select("route_index").distinct(), "route_index", "left_semi"))
    cut_nodes = cut_sites(shapes, site_pairs, *reach)
    hints = None
    if inputs.hints is not None:
        pieces = cut(S.polygon_pieces(walkable(inputs.hints).select(F.col("site_id").alias("node"), "rings")).select("node", "edges", *S.BOUNDS))
        hint_pairs = cut(near_context(outline(pieces), "node", *reach))
        near_hints = hint_pairs.select(F.col("node").alias("site_id")).distinct()
        hints = cut(inputs.hints.join(near_hints, "site_id", "left_semi"))
        cut_nodes = cut_nodes.unionByName(cut_sites(pieces, hint_pairs, *reach))
    edge = boundary_nodes(cut_routes(routes, route_pairs, *reach), cut_nodes)
    return replace(
        inputs, catalogue=local, routes=routes, barriers=cut(inputs.barriers.join(near_barriers, "node_id", "left_semi")),
        hints=hints, boundary_nodes=cut(edge),
    )


def reindex_routes(routes: DataFrame) -> DataFrame:
    """Dense route numbers for a regional run; the national number is kept."""
    from strollgraph.plans.prepare import dense_index

    kept = routes.withColumnRenamed("route_index", "original_route_index")
    return dense_index(kept, ["source_id", "original_route_index"])


def regional_accounting(accounting: DataFrame, land: DataFrame) -> DataFrame:
    """Accounting rows of the region's sources plus every reject."""
    here = land.select("source_id").distinct().withColumn("here", F.lit(True))
    return accounting.join(here, "source_id", "left").where("here or outcome = 'rejected'").drop("here")


def unresolved_sites(sites: DataFrame) -> DataFrame:
    return sites.where(F.col("reasons").contains("regional_context_incomplete") & ~F.col("status").isin(SETTLED))


def expand_context(
    run: Callable[[float], tuple[DataFrame, str, bool]], context_m: float = 20000.0, maximum_m: float = 80000.0
) -> tuple[DataFrame, float]:
    """Repeat ``run(buffer) -> (sites, context signature, limited by source)`` with doubled buffers.

    Stops when nothing is unresolved, the maximum is reached, the source ends or the context stays the same.
    """
    check_buffers(0.0, context_m, maximum_m)
    buffer_m, seen, sites = float(context_m), None, None
    while True:
        latest, signature, limited = run(buffer_m)
        if signature == seen:
            return sites, buffer_m
        sites, seen = latest, signature
        if limited or buffer_m >= maximum_m or unresolved_sites(sites).isEmpty():
            return sites, buffer_m
        buffer_m = min(float(maximum_m), buffer_m * 2)


def report_filter(
    sites: DataFrame,
    shapes: DataFrame,
    authorities: DataFrame | None = None,
    authority: str | None = None,
    box: tuple[float, float, float, float] | None = None,
    region_sites: DataFrame | None = None,
) -> DataFrame:
    """Sites reported for an authority code, a box or a region list."""
    if authority is not None:
        if authorities.where(F.col("code") == authority).isEmpty():
            raise ValueError(f"Unknown authority code: {authority}")
        listed = lambda c: F.array_contains(F.split(F.col(c), ";"), authority)
        sites = sites.where(listed("all_council_codes") | listed("all_county_codes"))
    if box is not None:
        west, south, east, north = check_box(*box)
        near = S.within_bbox(shapes, box)
        window = near.sparkSession.range(1).select(
            F.lit("box").alias("code"),
            F.expr(G.box_rings(f"{west}D", f"{south}D", f"{east}D", f"{north}D")).alias("rings"),
        )
        from strollgraph.operators.labels import meets_polygon

        hit = meets_polygon(near, window, ["code"]).select(F.col("node").alias("site_id"))
        sites = sites.join(hit, "site_id", "left_semi")
    if region_sites is not None:
        sites = sites.join(region_sites.select("site_id"), "site_id", "left_semi")
    return sites
