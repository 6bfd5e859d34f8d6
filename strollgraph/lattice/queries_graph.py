"""Site formation, graph, classification and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from strollgraph.functions import projection as R
from strollgraph.lattice.registry import query
from strollgraph.operators import classify as K
from strollgraph.operators import labels as L
from strollgraph.operators import network as N
from strollgraph.operators import sites as D
from strollgraph.operators import spatial as S
from strollgraph.operators.components import connected_components
from strollgraph.plans import analyse as A
from strollgraph.session import cut

R6 = lambda c: F.round(c, 6).alias(c)


@query("c3_touching_land", "SELECT a, b FROM touching")
def _(x):
    pieces = S.polygon_pieces(x.land.select("component_id", "rings"))
    return D.touching_pairs(D.touching_spans(pieces, pieces))


@query("h3_site_groups", "SELECT component_id, root FROM grouped")
def _(x):
    pieces = S.polygon_pieces(x.land.select("component_id", "rings"))
    roots = connected_components(D.touching_pairs(D.touching_spans(pieces, pieces)))
    return x.land.select("component_id").join(
        roots.withColumnRenamed("node", "component_id"), "component_id", "left"
    ).select("component_id", F.coalesce("root", "component_id").alias("root"))


@query(
    "p5_site_catalogue",
    "SELECT site_id, name, source_ids, parcel_count, component_count, area_ha FROM sites",
)
def _(x):
    return x.catalogue.sites.select(
        "site_id", "name", "source_ids", "parcel_count", "component_count", R6("area_ha")
    )


@query("p5_site_membership", "SELECT site_id, component_id FROM member")
def _(x):
    return x.catalogue.membership


@query("d2_union_area", "SELECT site_id, CAST(area_m2 AS DOUBLE) AS area_m2 FROM site_area")
def _(x):
    return D.outline_area(x.catalogue.outline, "site_id").select("site_id", R6("area_m2"))


@query("c12_shared_node_stars", "SELECT node, first_route, route_index FROM node_stars")
def _(x):
    return N.shared_node_pairs(x.routes, x.barriers)


@query("c2_endpoint_snaps", "SELECT a, b, distance, weak FROM snap_edges")
def _(x):
    e = N.snap_edges(x.routes, x.barriers, 5.0)
    number = lambda c: F.substring_index(c, ":", -1).cast("bigint").alias(c)
    return e.select(number("a"), number("b"), "distance", "weak")


@query(
    "c1_site_route_contacts",
    "SELECT node, route_index, tile_x, tile_y, tier, distance, inside_m, boundary_m, blocked, closed_boundary, grade_separated, weak FROM weighed",
)
def _(x):
    c = N.tile_contacts(x.shapes, x.routes, x.barriers, 5.0, 20000.0, cut)
    return c.withColumns({"inside_m": F.round("inside_m", 6), "boundary_m": F.round("boundary_m", 6)})


@query("d3_strongest_contacts", "SELECT node, route_index, tier, distance, weak FROM contacts")
def _(x):
    return x.graph.contacts


@query("c4_site_proximity", "SELECT a, b, distance FROM near_shapes")
def _(x):
    return N.nearby_shapes(x.shapes, 5.0)


@query("c5_contact_barriers", "SELECT node, route_index, tile_x, tile_y, blocked, entrance FROM barrier_flags")
def _(x):
    facts = cut(N.contact_facts(x.shapes, x.routes, 5.0, 20000.0))
    best = facts.groupBy(*N.CONTACT).agg(F.min("link").alias("link"))
    return N.blocked_shapes(N.contact_shapes(facts, best), x.barriers, N.CONTACT, 5.0)


@query("c6_contacts_under_bridges", "SELECT node, route_index, tile_x, tile_y FROM under_bridge")
def _(x):
    # The routes are chosen before the join: a condition on its result does not reach them through the kernels.
    flat = (F.col("tier") == "official") & (F.col("grade") == N.FLAT_GRADE)
    facts = cut(N.contact_facts(x.shapes, x.routes.where(flat), 5.0, 20000.0))
    best = facts.groupBy(*N.CONTACT).agg(F.min("link").alias("link"))
    return N.elevated_contacts(N.contact_shapes(facts, best), x.routes, 5.0)


@query("c7_road_seeds", "SELECT route_index, outside_m FROM seeds")
def _(x):
    return N.seed_routes(x.routes, x.shapes).select("route_index", R6("outside_m"))


@query("p9_graph_edges", "SELECT a, b, distance, weak FROM edges")
def _(x):
    return x.graph.edges.distinct()


@query("d4_contact_notes", "SELECT node, string_agg(reason, ';' ORDER BY reason) AS reasons FROM notes GROUP BY node")
def _(x):
    return x.graph.notes.groupBy("node").agg(
        F.array_join(F.array_sort(F.collect_set("reason")), ";").alias("reasons")
    )


@query("d5_contact_flags", "SELECT site_id, meets_unknown, meets_permissive, meets_safe FROM contact_flags")
def _(x):
    return K.contact_flags(x.graph.contacts)


@query("b29_admitted_edges", "SELECT DISTINCT variant, a, b FROM admitted")
def _(x):
    return K.variant_edges(x.graph.edges, x.graph.kinds, K.variants(2.0))


@query(
    "h1_variant_components",
    "SELECT variant, node, min(root) AS root FROM vwalk GROUP BY variant, node",
    vwalk="""SELECT variant, a AS node, a AS root FROM arcs UNION SELECT w.variant, t.b, w.root FROM vwalk w JOIN arcs t ON t.variant = w.variant AND t.a = w.node""",
)
def _(x):
    admitted = K.variant_edges(x.graph.edges, x.graph.kinds, K.variants(2.0))
    return connected_components(admitted, keys=["variant"])


@query("h2_reachable_sites", "SELECT * FROM reached")
def _(x):
    chosen = K.variants(2.0)
    roots = K.variant_roots(x.graph.edges, x.graph.kinds, chosen)
    seeds = K.variant_seeds(x.graph.seeds, x.graph.kinds, chosen)
    return K.reach_table(x.catalogue.sites.select("site_id"), roots, seeds, chosen)


@query("c10_coverage_gaps", "SELECT site_id FROM gap_sites")
def _(x):
    return A.uncovered_sites(A.Inputs(x.catalogue, None, None, gaps=x.councils.where("is_gap")), x.site_shapes)


@query(
    "p10_classify",
    """SELECT site_id, exact_access, default_access, relaxed_access, exact_permissive_access, default_permissive_access,
    relaxed_permissive_access, status, evidence_strength, reasons FROM classified""",
)
def _(x):
    return x.classified.select(
        "site_id", "exact_access", "default_access", "relaxed_access", "exact_permissive_access",
        "default_permissive_access", "relaxed_permissive_access", "status", "evidence_strength", "reasons",
    )


@query("d6_status_counts", "SELECT status, count(*) AS sites FROM classified GROUP BY status")
def _(x):
    return x.classified.groupBy("status").agg(F.count("*").alias("sites"))


@query("c8_council_overlap", "SELECT site_id, code, CAST(overlap_m2 AS DOUBLE) AS overlap_m2 FROM council_part")
def _(x):
    return L.overlay_areas(x.site_shapes, x.catalogue.outline, x.councils).select(
        "site_id", "code", R6("overlap_m2")
    )


@query(
    "c8_authority_labels",
    "SELECT site_id, council_code, council, all_council_codes, all_councils, county_code, county, all_county_codes, all_counties FROM labels_joined",
)
def _(x):
    return x.labelled.select(
        "site_id", "council_code", "council", "all_council_codes", "all_councils", "county_code", "county",
        "all_county_codes", "all_counties",
    )


@query(
    "e2_dominant_council",
    """SELECT site_id, code, CAST(overlap_m2 AS DOUBLE) AS overlap_m2 FROM
    (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY overlap_m2 DESC, code) AS n FROM council_part) t WHERE n = 1""",
)
def _(x):
    return L.dominant_boundary(L.overlay_areas(x.site_shapes, x.catalogue.outline, x.councils))


@query(
    "c9_nearest_route",
    "SELECT s.site_id, CASE WHEN d2 <= 6400.0 ** 2 THEN round(sqrt(d2), 6) END AS nearest_mapped_route_m FROM site_ids s LEFT JOIN nearest n USING (site_id)",
)
def _(x):
    return L.nearest_routes(x.site_shapes, x.routes).select("site_id", R6("nearest_mapped_route_m"))


@query("c11_nearby_hints", "SELECT site_id, unverified_common_ids FROM hint_links")
def _(x):
    return L.nearby_hints(x.site_shapes, x.hints, 5.0)


@query("b19_site_points", "SELECT site_id, easting, northing FROM points")
def _(x):
    return L.site_points(x.site_shapes).select("site_id", R6("easting"), R6("northing"))


@query("b20_grid_round_trip", "SELECT site_id, round(easting, 2) AS easting, round(northing, 2) AS northing FROM points")
def _(x):
    back = L.site_points(x.site_shapes).select("site_id", F.expr(R.lonlat_to_grid("longitude", "latitude")).alias("p"))
    return back.select("site_id", F.round("p.x", 2).alias("easting"), F.round("p.y", 2).alias("northing"))


@query("b10_shape_hash")
def _(x):
    return x.catalogue.sites.select("site_id", "geometry_sha256")


@query(
    "p11_screening_run",
    """SELECT c.site_id, c.name, c.area_ha, c.status, c.reasons, l.council, l.county, round(sqrt(n.d2), 6) AS nearest_mapped_route_m,
      p.easting, p.northing, coalesce(h.unverified_common_ids, '') AS unverified_common_ids
    FROM classified c JOIN labels_joined l USING (site_id) LEFT JOIN nearest n USING (site_id) JOIN points p USING (site_id) LEFT JOIN hint_links h USING (site_id)""",
)
def _(x):
    return x.labelled.select(
        "site_id", "name", R6("area_ha"), "status", "reasons", "council", "county", R6("nearest_mapped_route_m"),
        R6("easting"), R6("northing"), "unverified_common_ids",
    )
