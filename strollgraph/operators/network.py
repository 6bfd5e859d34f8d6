"""Graph edges, contacts and seeds from routes, sites and barriers.

Routes: ``route_index, tier, seed, start_node, end_node, grade, path``.
Shapes (site components and hints): ``node`` (graph node of the site), ``official_site``, plus the
columns of ``polygon_pieces``.  Barriers: ``node_id, blocking, path``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.operators import spatial as S
from strollgraph.session import cut

FLAT_GRADE = "0:no:no"
BARRIER_REACH_M = 0.25
SEED_OUTSIDE_M = 5.0
DEFAULT_TILE_M = 20000.0
EDGE = ["a", "b", "distance", "weak"]
CONTACT = ["node", "route_index", "tile_x", "tile_y"]


def route_node(route: str | Column) -> Column:
    """Graph node of a route; sites use their own id, so the two never meet."""
    return F.concat(F.lit("route:"), F.col(route).cast("string") if isinstance(route, str) else route.cast("string"))


def edge_rows(df: DataFrame, a: Column, b: Column, distance: Column, weak: Column) -> DataFrame:
    return df.select(a.alias("a"), b.alias("b"), distance.cast("double").alias("distance"), weak.alias("weak"))


def route_nodes(routes: DataFrame) -> DataFrame:
    """Start and end nodes of the routes that take part in the graph."""
    return (
        routes.where(F.col("tier") != "excluded")
        .select("route_index", F.explode(F.array("start_node", "end_node")).alias("node"))
        .where(F.col("node").isNotNull() & (F.col("node") != ""))
    )


def shared_node_pairs(routes: DataFrame, barriers: DataFrame) -> DataFrame:
    """Star of ``(node, first_route, route_index)`` per shared node; blocked nodes connect nothing."""
    blocked = (
        barriers.where(F.col("blocking") & (F.col("node_id") != ""))
        .select(F.concat(F.lit("osm:"), "node_id").alias("node"))
        .distinct()
    )
    nodes = route_nodes(routes).join(blocked, "node", "left_anti")
    # Partial minimum before the shuffle instead of a window: one busy node stays cheap.
    first = nodes.groupBy("node").agg(F.min("route_index").alias("first_route"))
    return nodes.join(first, "node").where(F.col("route_index") != F.col("first_route")).distinct()


def node_edges(routes: DataFrame, barriers: DataFrame) -> DataFrame:
    pairs = shared_node_pairs(routes, barriers).select("first_route", "route_index").distinct()
    return edge_rows(pairs, route_node("first_route"), route_node("route_index"), F.lit(0.0), F.lit(False))


def barrier_segments(barriers: DataFrame) -> DataFrame:
    """Barrier points and lines as segments; a point is a zero-length segment."""
    as_line = F.when(F.size("path") == 1, F.concat("path", "path")).otherwise(F.col("path"))
    return S.path_segments(barriers.withColumn("path", as_line), ["blocking"]).drop("edge_no")


def blocked_shapes(shapes: DataFrame, barriers: DataFrame, key: list[str], entrance_m: float) -> DataFrame:
    """Per key: is a blocking barrier on the shape, and is a passable one within ``entrance_m``."""
    reach = max(entrance_m, BARRIER_REACH_M)
    near = S.segment_links(S.segment_bounds(shapes), barrier_segments(barriers), reach)
    d2, blocking = F.col("link.d2"), F.col("b_blocking")
    return near.groupBy(*[F.col(f"a_{k}").alias(k) for k in key]).agg(
        F.bool_or(blocking & (d2 < BARRIER_REACH_M**2)).alias("blocked"),
        F.bool_or(~blocking & (d2 < reach**2)).alias("entrance"),
    )


def snap_links(routes: DataFrame, distance: float) -> DataFrame:
    """Ends of official lines against other walkable lines of the same grade within ``distance``."""
    ends = routes.where(F.col("tier") == "official").select(
        "route_index",
        "grade",
        F.posexplode(F.array(F.element_at("path", 1), F.element_at("path", -1))).alias("end_no", "p"),
    )
    ends = S.segment_bounds(
        ends.select("route_index", "grade", "end_no", F.expr(G.segment("p.x", "p.y", "p.x", "p.y")).alias("s"))
    )
    others = S.path_segments(routes.where(F.col("tier") != "excluded"), ["route_index", "grade"]).drop("edge_no")
    links = S.segment_links(
        ends,
        others,
        distance,
        condition=(F.col("a_route_index") != F.col("b_route_index")) & (F.col("a_grade") == F.col("b_grade")),
    )
    return links.groupBy(
        F.col("a_route_index").alias("route_index"),
        F.col("a_end_no").alias("end_no"),
        F.col("b_route_index").alias("other_index"),
    ).agg(F.min("link").alias("link"))


def snap_edges(routes: DataFrame, barriers: DataFrame, distance: float) -> DataFrame:
    key = ["route_index", "end_no", "other_index"]
    links = cut(snap_links(routes, distance))  # read twice, and its pairs are measured by expressions
    flags = blocked_shapes(
        links.select(*key, F.expr(G.link_segment("link")).alias("s")), barriers, key, 0.0
    ).drop("entrance")
    joined = links.join(flags, key, "left")
    low, high = F.least("route_index", "other_index"), F.greatest("route_index", "other_index")
    return edge_rows(
        joined, route_node(low), route_node(high), F.sqrt("link.d2"), F.coalesce("blocked", F.lit(False))
    ).distinct()


def route_pieces(routes: DataFrame, tile: float, keep: list[str]) -> DataFrame:
    """Route segments clipped to closed tiles; a seam point belongs to both tiles."""

    t = f"{float(tile)}D"
    pieces = S.path_segments(routes, keep)
    for axis in ("x", "y"):
        low = f"cast(ceil({axis}min / {t}) - 1 as bigint)"
        pieces = pieces.withColumn(
            f"tile_{axis}", F.expr(f"explode(sequence({low}, {G.tile_index(f'{axis}max', tile)}))")
        )
    part = G.clip_segment("s", f"tile_x * {t}", f"tile_y * {t}", f"(tile_x + 1) * {t}", f"(tile_y + 1) * {t}")
    # Most segments lie within one tile and are taken as they are.
    single = " and ".join(f"ceil({a}min / {t}) - 1 = {G.tile_index(f'{a}max', tile)}" for a in ("x", "y"))
    clipped = F.expr(f"explode(if({single}, array(s), filter(array({part}), e -> e is not null)))")
    return S.segment_bounds(pieces.withColumn("s", clipped).drop(*S.BOUNDS))


def contact_facts(shapes: DataFrame, routes: DataFrame, distance: float, tile: float) -> DataFrame:
    """Route segments of a tile against every nearby site component."""
    pieces = route_pieces(routes, tile, ["route_index", "tier", "seed", "grade"])
    pairs = S.near_pairs(pieces, shapes.select("node", "edges", *S.BOUNDS), distance)
    return S.link_distance(pairs, distance).select(
        F.col("b_node").alias("node"),
        F.col("a_route_index").alias("route_index"),
        F.col("a_tile_x").alias("tile_x"),
        F.col("a_tile_y").alias("tile_y"),
        F.col("a_edge_no").alias("edge_no"),
        F.col("a_s").alias("s"),
        F.col("a_tier").alias("tier"),
        F.col("a_seed").alias("seed"),
        F.col("a_grade").alias("grade"),
        "left", "right", "link",
    )


def contact_lengths(facts: DataFrame) -> DataFrame:
    """Inside, boundary and total length of a route piece against the union of a site's components."""
    spans = S.explode_spans(facts.select(*CONTACT, "edge_no", "s", "left", "right"))
    measured = S.union_measures(
        spans,
        [*CONTACT, "edge_no", "s"],
        {"l": F.col("is_left"), "r": ~F.col("is_left"), "u": F.lit(True)},
    )
    length = F.expr(G.edge_length("s"))
    return measured.groupBy(*CONTACT).agg(
        F.sum((F.col("l") + F.col("r") - F.col("u")) * length).alias("inside_m"),
        F.sum((2 * F.col("u") - F.col("l") - F.col("r")) * length).alias("boundary_m"),
        F.sum(F.col("u") * length).alias("shared_m"),
    )


def contact_shapes(facts: DataFrame, best: DataFrame) -> DataFrame:
    """Where site and route meet, or their shortest connection: one row per straight part."""
    meeting = facts.where(F.col("link.d2") == 0)
    stretches = F.concat("left", "right")
    parts = meeting.select(*CONTACT, "s", F.explode(stretches).alias("p")).select(
        *CONTACT, "s", F.col("p.t0").alias("t0"), F.col("p.t1").alias("t1")
    )
    parts = parts.select(*CONTACT, F.expr(G.part_of("s", "t0", "t1")).alias("s"))
    touches = meeting.where(F.size(stretches) == 0).select(*CONTACT, F.expr(G.link_segment("link")).alias("s"))
    gaps = best.where(F.col("link.d2") > 0).select(*CONTACT, F.expr(G.link_segment("link")).alias("s"))
    return parts.unionByName(touches).unionByName(gaps).distinct()


def elevated_contacts(shapes: DataFrame, routes: DataFrame, distance: float) -> DataFrame:
    """Contacts that lie wholly within ``distance`` of bridges or tunnels."""
    raised = S.path_segments(
        routes.where(F.col("grade") != FLAT_GRADE), ["route_index"]
    ).drop("edge_no", "route_index")
    near = S.near_pairs(S.segment_bounds(shapes), raised, distance)
    near = near.withColumn(
        "p", G.keep(G.capsule_span("a_s", "b_s", distance), "c", "c is not null")
    )
    key = [f"a_{k}" for k in CONTACT]
    c = F.col("a_s")
    is_point = (c["x0"] == c["x1"]) & (c["y0"] == c["y1"])
    covered = S.union_measures(
        near.select(*key, "a_s", F.col("p.t0").alias("t0"), F.col("p.t1").alias("t1")),
        [*key, "a_s"],
        {"u": F.lit(True)},
    ).where((F.col("u") >= 1 - 1e-9) | is_point)
    done = covered.groupBy(*[F.col(f"a_{k}").alias(k) for k in CONTACT]).agg(F.count("*").alias("covered_parts"))
    parts = shapes.groupBy(*CONTACT).agg(F.count("*").alias("parts"))
    return parts.join(done, CONTACT).where(F.col("parts") == F.col("covered_parts")).select(*CONTACT)


def tile_contacts(
    shapes: DataFrame, routes: DataFrame, barriers: DataFrame, distance: float, tile: float, cut=lambda df: df
) -> DataFrame:
    """Every contact per tile piece with its evidence flags."""
    facts = cut(contact_facts(shapes, routes, distance, tile))
    best = facts.groupBy(*CONTACT, "tier", "seed", "grade").agg(F.min("link").alias("link"))
    parts = contact_shapes(facts, best)
    flags = blocked_shapes(parts, barriers, CONTACT, distance)
    flat_official = best.where((F.col("tier") == "official") & (F.col("grade") == FLAT_GRADE)).select(*CONTACT)
    raised = elevated_contacts(parts.join(flat_official, CONTACT, "left_semi"), routes, distance).withColumn(
        "raised", F.lit(True)
    )
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    metres = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    rows = (
        best.join(contact_lengths(facts), CONTACT, "left").join(flags, CONTACT, "left").join(raised, CONTACT, "left")
    )
    boundary_only = ((metres("boundary_m") > 1e-9) & (metres("inside_m") <= 1e-9)) | (
        F.col("seed") & (F.col("link.d2") == 0) & (metres("shared_m") <= 1e-9)
    )
    rows = rows.select(
        *CONTACT,
        "tier",
        F.sqrt("link.d2").alias("distance"),
        metres("inside_m").alias("inside_m"),
        metres("boundary_m").alias("boundary_m"),
        yes("blocked").alias("blocked"),
        (boundary_only & ~yes("entrance")).alias("closed_boundary"),
        ((F.col("grade") != FLAT_GRADE) | yes("raised")).alias("grade_separated"),
    )
    return rows.withColumn("weak", F.col("blocked") | F.col("closed_boundary") | F.col("grade_separated"))


def strongest_contacts(contacts: DataFrame) -> DataFrame:
    """One contact per site and route: a strong piece wins, then the smallest distance."""
    best = contacts.groupBy("node", "route_index", "tier").agg(F.min(F.struct("weak", "distance")).alias("best"))
    return best.select("node", "route_index", "tier", "best.distance", "best.weak")


def contact_edges(contacts: DataFrame) -> DataFrame:
    kept = contacts.where(F.col("tier") != "excluded")
    return edge_rows(kept, route_node("route_index"), F.col("node"), F.col("distance"), F.col("weak")).distinct()


def contact_notes(contacts: DataFrame) -> DataFrame:
    """Review notes raised by contacts: ``node, reason``."""
    reasons = F.array_compact(
        F.array(
            F.when(F.col("blocked"), "mapped_barrier_at_contact"),
            F.when(F.col("closed_boundary"), "boundary_contact_without_entrance"),
            F.when(
                F.col("grade_separated") & (F.col("tier") != "excluded"), "possible_grade_separation_at_contact"
            ),
        )
    )
    return contacts.select("node", F.explode(reasons).alias("reason")).distinct()


def seed_routes(routes: DataFrame, shapes: DataFrame) -> DataFrame:
    """Possible road seeds with more than 5 m outside official sites: ``route_index, outside_m``."""
    roads = S.path_segments(routes.where(F.col("seed")), ["route_index"])
    lengths = roads.groupBy("route_index").agg(
        F.sum(F.expr(G.edge_length("s"))).alias("length_m")
    )
    spans = S.covered_spans(roads, shapes.where("official_site").select("edges", *S.BOUNDS))
    covered = (
        S.union_measures(spans, ["a_route_index", "a_edge_no", "a_s"], {"u": F.lit(True)})
        .groupBy(F.col("a_route_index").alias("route_index"))
        .agg(
            F.sum(F.col("u") * F.expr(G.edge_length("a_s"))).alias("covered_m")
        )
    )
    outside = F.col("length_m") - F.coalesce("covered_m", F.lit(0.0))
    return (
        lengths.join(covered, "route_index", "left")
        .select("route_index", outside.alias("outside_m"))
        .where(F.col("outside_m") > SEED_OUTSIDE_M + 1e-9)
    )


def nearby_shapes(shapes: DataFrame, distance: float) -> DataFrame:
    """Pairs of different sites or hints within ``distance``: ``a, b, distance``."""
    segments = S.outline_segments(shapes, ["node"]).drop("edge_no")
    pairs = S.near_pairs(
        segments, shapes.select("node", "edges", *S.BOUNDS), distance, condition=F.col("a_node") != F.col("b_node")
    )
    linked = S.link_distance(pairs, distance)
    return (
        linked.groupBy(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"))
        .agg(F.min("link.d2").alias("d2"))
        .select("a", "b", F.sqrt("d2").alias("distance"))
    )


def nearby_edges(pairs: DataFrame) -> DataFrame:
    return edge_rows(pairs, F.col("a"), F.col("b"), F.col("distance"), F.lit(True))


def nearby_notes(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.explode(F.array("a", "b")).alias("node"), F.lit("uncertain_land_connection").alias("reason")
    ).distinct()
