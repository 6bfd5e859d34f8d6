"""SQL twins of the operators on the lattice, as named common table expressions.

Boxes and axis-parallel routes allow closed forms, so these texts share no method with the
Spark side.  ``build`` prefixes a SELECT with the expressions it needs.
"""

from __future__ import annotations

import re

from strollgraph.lattice import tables as T

POLICY_CASE = """CASE
  WHEN {official} THEN {o}
  WHEN {highway} IN ('motorway', 'motorway_link', 'construction', 'proposed') THEN {x}
  WHEN {public} AND {foot} IN ({blocked}) THEN {c}
  WHEN {eff} IN ({blocked}) THEN {x}
  WHEN {cond} THEN {k}
  WHEN {eff} = 'permissive' THEN {p}
  WHEN {eff} IN ('yes', 'designated', 'official') OR {public} THEN {y}
  WHEN {road} AND {eff} = '' THEN {i}
  ELSE {u} END"""
BLOCKED = "'no', 'private', 'customers', 'delivery', 'agricultural', 'forestry', 'use_sidepath'"
ROADS = (
    "'primary', 'secondary', 'tertiary', 'unclassified', 'residential', 'living_street', 'primary_link', "
    "'secondary_link', 'tertiary_link', 'pedestrian'"
)
PUBLIC = "'public_footpath', 'public_bridleway', 'restricted_byway', 'byway_open_to_all_traffic'"


def policy(part: str, highway="highway", foot="foot", access="access_tag", designation="''", official="false", cond="false") -> str:
    """SQL for one field (tier, seed or reason) of the pedestrian decision."""
    road = f"{highway} IN ({ROADS})"
    values = {
        "tier": dict(o="'official'", x="'excluded'", c="'unknown'", k="'unknown'", p="'permissive'", y="'public'", i="'inferred'", u="'unknown'"),
        "seed": dict(o="false", x="false", c="false", k=road, p="false", y=road, i="true", u="false"),
        "reason": dict(o="''", x="'pedestrian_prohibited'", c="'conflicting_access_tags'", k="'conditional_access'",
                       p="'permissive_only'", y="''", i="'road_access_inferred'", u="'access_not_recorded'"),
    }[part]
    return POLICY_CASE.format(
        official=official, highway=highway, foot=foot, eff=f"CASE WHEN {foot} <> '' THEN {foot} ELSE {access} END",
        public=f"{designation} IN ({PUBLIC})", blocked=BLOCKED, cond=cond, road=road, **values,
    )


TIER_SAFE = "'official', 'public', 'inferred'"

CTE: dict[str, str] = {
    "land": T.LAND_SQL,
    "routes_raw": T.ROUTES_SQL,
    "routes": f"""SELECT *, {policy('tier', official='official')} AS tier, {policy('seed', official='official')} AS seed,
        {policy('reason', official='official')} AS reason,
        CASE WHEN official THEN '' ELSE concat('osm:', start_no) END AS start_node,
        CASE WHEN official THEN '' ELSE concat('osm:', end_no) END AS end_node FROM routes_raw""",
    "barriers": f"""SELECT *, CAST(node_no AS VARCHAR) AS node_id, CASE WHEN access_tag IN ({BLOCKED}) THEN true
        WHEN barrier IN ('gate', 'kissing_gate', 'stile', 'entrance', 'bollard', 'cycle_barrier') THEN false
        ELSE barrier <> '' AND access_tag NOT IN ('yes', 'designated', 'official') END AS blocking
        FROM ({T.BARRIERS_SQL}) b""",
    "hints": f"SELECT *, concat('hint:', source_id) AS site_id FROM ({T.HINTS_SQL}) h",
    "councils": T.COUNCILS_SQL,
    "counties": T.COUNTIES_SQL,
    "way_nodes": T.WAY_NODES_SQL,
    "reviews": T.REVIEWS_SQL,
    "touching": """SELECT a.component_id AS a, b.component_id AS b FROM land a JOIN land b
        ON a.component_id < b.component_id AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1
        AND (least(a.x1, b.x1) > greatest(a.x0, b.x0) OR least(a.y1, b.y1) > greatest(a.y0, b.y0))""",
    "walk": """SELECT component_id AS node, component_id AS root FROM land
        UNION SELECT t.b, w.root FROM walk w JOIN (SELECT a, b FROM touching UNION ALL SELECT b, a FROM touching) t ON t.a = w.node""",
    "grouped": "SELECT node AS component_id, min(root) AS root FROM walk GROUP BY node",
    "site_ids": """SELECT root, concat('site-', substr(sha256('["' || string_agg(component_id, '", "' ORDER BY component_id) || '"]'), 1, 16)) AS site_id
        FROM grouped GROUP BY root""",
    "member": "SELECT s.site_id, l.* FROM grouped g JOIN site_ids s USING (root) JOIN land l USING (component_id)",
    # Elementary cells of each site's own coordinates; a cell counts once however many boxes hold it.
    "cell_x": """SELECT site_id, x AS xa, lead(x) OVER (PARTITION BY site_id ORDER BY x) AS xb
        FROM (SELECT site_id, x0 AS x FROM member UNION SELECT site_id, x1 FROM member) t""",
    "cell_y": """SELECT site_id, y AS ya, lead(y) OVER (PARTITION BY site_id ORDER BY y) AS yb
        FROM (SELECT site_id, y0 AS y FROM member UNION SELECT site_id, y1 FROM member) t""",
    "cells": """SELECT x.site_id, xa, xb, ya, yb FROM cell_x x JOIN cell_y y ON x.site_id = y.site_id AND xb IS NOT NULL AND yb IS NOT NULL
        WHERE EXISTS (SELECT 1 FROM member m WHERE m.site_id = x.site_id AND m.x0 <= xa AND m.x1 >= xb AND m.y0 <= ya AND m.y1 >= yb)""",
    "site_area": "SELECT site_id, CAST(sum((xb - xa) * (yb - ya)) AS BIGINT) AS area_m2 FROM cells GROUP BY site_id",
    "sites": """SELECT m.site_id, coalesce(nullif(string_agg(DISTINCT nullif(name, ''), '; ' ORDER BY nullif(name, '')), ''),
          concat('Unnamed access land ', substr(m.site_id, 6, 8))) AS name,
        string_agg(DISTINCT source_id, ';' ORDER BY source_id) AS source_ids,
        count(DISTINCT source_id) AS parcel_count, count(*) AS component_count,
        any_value(a.area_m2) AS area_m2, round(any_value(a.area_m2) / 10000.0, 6) AS area_ha
        FROM member m JOIN site_area a ON a.site_id = m.site_id GROUP BY m.site_id""",
    "walkable": "SELECT * FROM hints WHERE NOT (CASE WHEN foot <> '' THEN foot ELSE access END IN (%s))" % BLOCKED,
    "shapes": """SELECT site_id AS node, true AS official_site, x0, y0, x1, y1 FROM member
        UNION ALL SELECT site_id, false, x0, y0, x1, y1 FROM walkable""",
    # --- graph ---
    "blocked_nodes": "SELECT DISTINCT concat('osm:', node_id) AS node FROM barriers WHERE blocking",
    "route_ends": """SELECT * FROM (SELECT start_node AS node, route_index FROM routes WHERE start_node <> '' AND tier <> 'excluded'
        UNION ALL SELECT end_node, route_index FROM routes WHERE end_node <> '' AND tier <> 'excluded') t
        WHERE node NOT IN (SELECT node FROM blocked_nodes)""",
    "node_stars": """SELECT DISTINCT e.node, f.first_route, e.route_index FROM route_ends e
        JOIN (SELECT node, min(route_index) AS first_route FROM route_ends GROUP BY node) f ON e.node = f.node
        WHERE e.route_index <> f.first_route""",
    "official_ends": """SELECT route_index, grade, 0 AS end_no, x0 AS x, y0 AS y FROM routes WHERE tier = 'official'
        UNION ALL SELECT route_index, grade, 1, x1, y1 FROM routes WHERE tier = 'official'""",
    "snaps": """SELECT e.route_index, e.end_no, r.route_index AS other_index, e.x, e.y,
          greatest(r.x0, least(r.x1, e.x)) AS qx, greatest(r.y0, least(r.y1, e.y)) AS qy
        FROM official_ends e JOIN routes r ON r.route_index <> e.route_index AND r.tier <> 'excluded' AND r.grade = e.grade
          AND e.x BETWEEN r.x0 - 5 AND r.x1 + 5 AND e.y BETWEEN r.y0 - 5 AND r.y1 + 5
        WHERE (e.x - greatest(r.x0, least(r.x1, e.x))) ** 2 + (e.y - greatest(r.y0, least(r.y1, e.y))) ** 2 <= 25""",
    "snap_edges": """SELECT DISTINCT least(route_index, other_index) AS a, greatest(route_index, other_index) AS b,
          sqrt((x - qx) ** 2 + (y - qy) ** 2) AS distance,
          EXISTS (SELECT 1 FROM barriers k WHERE k.blocking AND k.x BETWEEN least(s.x, qx) AND greatest(s.x, qx)
            AND k.y BETWEEN least(s.y, qy) AND greatest(s.y, qy)) AS weak
        FROM snaps s""",
    "tile_no": "SELECT unnest(generate_series(-1, 12)) AS k",
    "route_pieces": """SELECT route_index, tier, seed, grade, tx.k AS tile_x, ty.k AS tile_y,
          greatest(x0, tx.k * 20000) AS x0, least(x1, (tx.k + 1) * 20000) AS x1,
          greatest(y0, ty.k * 20000) AS y0, least(y1, (ty.k + 1) * 20000) AS y1
        FROM routes JOIN tile_no tx ON x1 >= tx.k * 20000 AND x0 <= (tx.k + 1) * 20000
        JOIN tile_no ty ON y1 >= ty.k * 20000 AND y0 <= (ty.k + 1) * 20000""",
    "fact": """SELECT s.node, p.route_index, p.tile_x, p.tile_y, p.tier, p.seed, p.grade, p.x0 AS px0, p.x1 AS px1, p.y0 AS py0, p.y1 AS py1,
          s.x0, s.y0, s.x1, s.y1,
          greatest(0, s.x0 - p.x1, p.x0 - s.x1) ** 2 + greatest(0, s.y0 - p.y1, p.y0 - s.y1) ** 2 AS d2
        FROM route_pieces p JOIN shapes s ON s.x0 - 5 <= p.x1 AND s.x1 + 5 >= p.x0 AND s.y0 - 5 <= p.y1 AND s.y1 + 5 >= p.y0
        WHERE greatest(0, s.x0 - p.x1, p.x0 - s.x1) ** 2 + greatest(0, s.y0 - p.y1, p.y0 - s.y1) ** 2 <= 25""",
    "best": """SELECT node, route_index, tile_x, tile_y, tier, seed, grade, min(d2) AS d2 FROM fact
        GROUP BY node, route_index, tile_x, tile_y, tier, seed, grade""",
    # Where they meet, or the (leftmost) shortest connection: always an axis-parallel box of no width.
    "meeting": """SELECT DISTINCT f.node, f.route_index, f.tile_x, f.tile_y, f.tier, f.grade,
          CASE WHEN f.d2 = 0 THEN greatest(px0, x0) WHEN px0 > x1 THEN x1 WHEN x0 > px1 THEN px1 ELSE greatest(px0, x0) END AS gx0,
          CASE WHEN f.d2 = 0 THEN least(px1, x1) WHEN px0 > x1 THEN px0 WHEN x0 > px1 THEN x0 ELSE greatest(px0, x0) END AS gx1,
          CASE WHEN f.d2 = 0 THEN greatest(py0, y0) WHEN py0 > y1 THEN y1 WHEN y0 > py1 THEN py1 ELSE greatest(py0, y0) END AS gy0,
          CASE WHEN f.d2 = 0 THEN least(py1, y1) WHEN py0 > y1 THEN py0 WHEN y0 > py1 THEN y0 ELSE greatest(py0, y0) END AS gy1
        FROM fact f JOIN best b ON b.node = f.node AND b.route_index = f.route_index AND b.tile_x = f.tile_x AND b.tile_y = f.tile_y AND b.d2 = f.d2""",
    # Sides of a piece covered by a box, along the running coordinate.
    "side": """SELECT node, route_index, tile_x, tile_y,
          CASE WHEN px0 = px1 THEN greatest(py0, y0) ELSE greatest(px0, x0) END AS ta,
          CASE WHEN px0 = px1 THEN least(py1, y1) ELSE least(px1, x1) END AS tb,
          CASE WHEN px0 = px1 THEN x0 < px0 AND px0 <= x1 ELSE y0 < py0 AND py0 <= y1 END AS low_side,
          CASE WHEN px0 = px1 THEN x0 <= px0 AND px0 < x1 ELSE y0 <= py0 AND py0 < y1 END AS high_side
        FROM fact WHERE d2 = 0""",
    "cuts": """SELECT node, route_index, tile_x, tile_y, t AS ta, lead(t) OVER (PARTITION BY node, route_index, tile_x, tile_y ORDER BY t) AS tb
        FROM (SELECT node, route_index, tile_x, tile_y, ta AS t FROM side WHERE tb > ta UNION SELECT node, route_index, tile_x, tile_y, tb FROM side WHERE tb > ta) q""",
    "cut_sides": """SELECT c.node, c.route_index, c.tile_x, c.tile_y, c.ta, c.tb, bool_or(s.low_side) AS low_side, bool_or(s.high_side) AS high_side
        FROM cuts c JOIN side s ON s.node = c.node AND s.route_index = c.route_index AND s.tile_x = c.tile_x AND s.tile_y = c.tile_y
          AND s.ta <= c.ta AND s.tb >= c.tb WHERE c.tb IS NOT NULL GROUP BY ALL""",
    "lengths": """SELECT node, route_index, tile_x, tile_y,
          sum(CASE WHEN low_side AND high_side THEN tb - ta ELSE 0 END) AS inside_m,
          sum(CASE WHEN low_side <> high_side THEN tb - ta ELSE 0 END) AS boundary_m FROM cut_sides
        GROUP BY node, route_index, tile_x, tile_y""",
    "barrier_gap": """SELECT m.node, m.route_index, m.tile_x, m.tile_y, k.blocking,
          greatest(0, gx0 - k.x, k.x - gx1) ** 2 + greatest(0, gy0 - k.y, k.y - gy1) ** 2 AS d2
        FROM meeting m JOIN barriers k ON k.x BETWEEN gx0 - 5 AND gx1 + 5 AND k.y BETWEEN gy0 - 5 AND gy1 + 5""",
    "barrier_flags": """SELECT node, route_index, tile_x, tile_y, bool_or(blocking AND d2 = 0) AS blocked, bool_or(NOT blocking AND d2 < 25) AS entrance
        FROM barrier_gap GROUP BY node, route_index, tile_x, tile_y""",
    "under_bridge": """SELECT m.node, m.route_index, m.tile_x, m.tile_y FROM meeting m
        WHERE m.tier = 'official' AND m.grade = '0:no:no'
        GROUP BY m.node, m.route_index, m.tile_x, m.tile_y
        HAVING bool_and(EXISTS (SELECT 1 FROM routes e WHERE e.grade <> '0:no:no'
            AND greatest(0, e.x0 - gx0, gx0 - e.x1) ** 2 + greatest(0, e.y0 - gy0, gy0 - e.y1) ** 2 <= 25
            AND greatest(0, e.x0 - gx1, gx1 - e.x1) ** 2 + greatest(0, e.y0 - gy1, gy1 - e.y1) ** 2 <= 25))""",
    "tile_contacts": """SELECT b.node, b.route_index, b.tile_x, b.tile_y, b.tier, sqrt(b.d2) AS distance,
          CAST(coalesce(l.inside_m, 0) AS DOUBLE) AS inside_m, CAST(coalesce(l.boundary_m, 0) AS DOUBLE) AS boundary_m,
          coalesce(f.blocked, false) AS blocked,
          ((coalesce(l.boundary_m, 0) > 0 AND coalesce(l.inside_m, 0) = 0) OR (b.seed AND b.d2 = 0 AND coalesce(l.boundary_m, 0) + coalesce(l.inside_m, 0) = 0))
            AND NOT coalesce(f.entrance, false) AS closed_boundary,
          b.grade <> '0:no:no' OR u.node IS NOT NULL AS grade_separated
        FROM best b LEFT JOIN lengths l USING (node, route_index, tile_x, tile_y)
        LEFT JOIN barrier_flags f USING (node, route_index, tile_x, tile_y)
        LEFT JOIN under_bridge u USING (node, route_index, tile_x, tile_y)""",
    "weighed": "SELECT *, blocked OR closed_boundary OR grade_separated AS weak FROM tile_contacts",
    "contacts": """SELECT node, route_index, tier, distance, weak FROM (SELECT *, row_number() OVER (PARTITION BY node, route_index ORDER BY weak, distance) AS n
        FROM weighed) t WHERE n = 1""",
    "near_shapes": """SELECT a.node AS a, b.node AS b,
          sqrt(min(greatest(0, a.x0 - b.x1, b.x0 - a.x1) ** 2 + greatest(0, a.y0 - b.y1, b.y0 - a.y1) ** 2)) AS distance
        FROM shapes a JOIN shapes b ON a.node < b.node AND a.x0 - 5 <= b.x1 AND a.x1 + 5 >= b.x0 AND a.y0 - 5 <= b.y1 AND a.y1 + 5 >= b.y0
        WHERE greatest(0, a.x0 - b.x1, b.x0 - a.x1) ** 2 + greatest(0, a.y0 - b.y1, b.y0 - a.y1) ** 2 <= 25
        GROUP BY a.node, b.node""",
    "edges": """SELECT DISTINCT concat('route:', first_route) AS a, concat('route:', route_index) AS b, 0.0::DOUBLE AS distance, false AS weak FROM node_stars
        UNION SELECT concat('route:', a), concat('route:', b), distance, weak FROM snap_edges
        UNION SELECT concat('route:', route_index), node, distance, weak FROM weighed WHERE tier <> 'excluded'
        UNION SELECT a, b, distance, true FROM near_shapes""",
    "seed_cover": """SELECT r.route_index, r.x1 - r.x0 + r.y1 - r.y0 AS length_m, r.x0, r.x1, r.y0, r.y1 FROM routes r WHERE r.seed""",
    "seed_side": """SELECT r.route_index, greatest(r.x0, s.x0) AS ta, least(r.x1, s.x1) AS tb FROM seed_cover r JOIN member s
        ON s.x0 < r.x1 AND s.x1 > r.x0 AND r.y0 BETWEEN s.y0 AND s.y1""",
    "seed_inside": """SELECT route_index, sum(greatest(0, tb - greatest(ta, coalesce(furthest, ta)))) AS covered_m FROM
        (SELECT *, max(tb) OVER (PARTITION BY route_index ORDER BY ta, tb ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS furthest FROM seed_side) t
        GROUP BY route_index""",
    "seeds": """SELECT r.route_index, CAST(r.length_m - coalesce(c.covered_m, 0) AS DOUBLE) AS outside_m FROM seed_cover r LEFT JOIN seed_inside c USING (route_index)
        WHERE r.length_m - coalesce(c.covered_m, 0) > 5""",
    "boxes": "SELECT site_id, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM member GROUP BY site_id",
    "hint_links": """SELECT b.site_id, string_agg(DISTINCT h.source_id, ';' ORDER BY h.source_id) AS unverified_common_ids FROM boxes b JOIN hints h
        ON h.x0 <= b.x1 + 5 AND h.x1 >= b.x0 - 5 AND h.y0 <= b.y1 + 5 AND h.y1 >= b.y0 - 5 GROUP BY b.site_id""",
    "notes": """SELECT node, 'mapped_barrier_at_contact' AS reason FROM weighed WHERE blocked
        UNION SELECT node, 'boundary_contact_without_entrance' FROM weighed WHERE closed_boundary
        UNION SELECT node, 'possible_grade_separation_at_contact' FROM weighed WHERE grade_separated AND tier <> 'excluded'
        UNION SELECT a, 'uncertain_land_connection' FROM near_shapes UNION SELECT b, 'uncertain_land_connection' FROM near_shapes
        UNION SELECT site_id, 'unverified_osm_common_nearby' FROM hint_links""",
    "kinds": """SELECT concat('route:', route_index) AS node, tier AS kind FROM routes UNION ALL SELECT DISTINCT site_id, 'site' FROM member
        UNION ALL SELECT site_id, 'hint' FROM walkable""",
    "variants": """SELECT * FROM (VALUES ('exact_access', 0.0, 1), ('default_access', 2.0, 1), ('relaxed_access', 5.0, 1), ('exact_permissive_access', 0.0, 2),
        ('default_permissive_access', 2.0, 2), ('relaxed_permissive_access', 5.0, 2), ('possible_access', 5.0, 3)) v(variant, tolerance, breadth)""",
    "kind_levels": f"""SELECT node, CASE WHEN kind IN ({TIER_SAFE}, 'site') THEN 1 WHEN kind = 'permissive' THEN 2 WHEN kind IN ('unknown', 'hint') THEN 3 ELSE 9 END AS level
        FROM kinds""",
    "leveled": """SELECT e.a, e.b, e.distance, e.weak, greatest(x.level, y.level) AS level
        FROM edges e JOIN kind_levels x ON x.node = e.a JOIN kind_levels y ON y.node = e.b""",
    "admitted": """SELECT DISTINCT v.variant, e.a, e.b FROM leveled e JOIN variants v
        ON e.distance <= v.tolerance AND (v.breadth = 3 OR NOT e.weak) AND e.level <= v.breadth""",
    "arcs": "SELECT variant, a, b FROM admitted UNION SELECT variant, b, a FROM admitted",
    "reach": """SELECT v.variant, k.node FROM seeds s JOIN kind_levels k ON k.node = concat('route:', s.route_index) JOIN variants v ON k.level <= v.breadth
        UNION SELECT r.variant, a.b FROM reach r JOIN arcs a ON a.variant = r.variant AND a.a = r.node""",
    "reached": """SELECT s.site_id, bool_or(variant = 'exact_access') AS exact_access, bool_or(variant = 'default_access') AS default_access,
          bool_or(variant = 'relaxed_access') AS relaxed_access, bool_or(variant = 'exact_permissive_access') AS exact_permissive_access,
          bool_or(variant = 'default_permissive_access') AS default_permissive_access,
          bool_or(variant = 'relaxed_permissive_access') AS relaxed_permissive_access, bool_or(variant = 'possible_access') AS possible_access
        FROM (SELECT DISTINCT site_id FROM member) s LEFT JOIN (SELECT variant, node FROM reach UNION ALL SELECT 'none', site_id FROM site_ids) r ON r.node = s.site_id
        GROUP BY s.site_id""",
    "gap_sites": """SELECT DISTINCT m.site_id FROM member m JOIN councils c ON c.is_gap AND m.x0 <= c.x1 AND m.x1 >= c.x0 AND m.y0 <= c.y1 AND m.y1 >= c.y0""",
    "contact_flags": f"""SELECT node AS site_id, bool_or(tier = 'unknown') AS meets_unknown, bool_or(tier = 'permissive') AS meets_permissive,
        bool_or(tier IN ({TIER_SAFE})) AS meets_safe FROM contacts GROUP BY node""",
    "all_notes": """SELECT node AS site_id, reason FROM notes WHERE node LIKE 'site-%'
        UNION SELECT site_id, 'very_small_site_geometry' FROM site_area WHERE area_m2 < 1500
        UNION SELECT site_id, 'official_coverage_missing' FROM gap_sites
        UNION SELECT site_id, 'nearby_route_access_unknown' FROM contact_flags WHERE meets_unknown AND site_id LIKE 'site-%'
        UNION SELECT site_id, 'permissive_route_nearby' FROM contact_flags WHERE meets_permissive AND site_id LIKE 'site-%'
        UNION SELECT site_id, 'tolerance_sensitive' FROM reached WHERE exact_access <> relaxed_access""",
    "decided": """SELECT r.*, CASE WHEN default_access AND exact_access = relaxed_access THEN 'access_evidenced'
          WHEN exact_permissive_access AND default_permissive_access AND relaxed_permissive_access THEN 'permissive_access_evidenced'
          WHEN default_access OR possible_access OR EXISTS (SELECT 1 FROM all_notes n WHERE n.site_id = r.site_id) THEN 'uncertain'
          ELSE 'likely_access_island' END AS status FROM reached r""",
    "final_notes": """SELECT site_id, reason FROM all_notes
        UNION SELECT site_id, 'connected_to_pedestrian_road' FROM decided WHERE status = 'access_evidenced'
        UNION SELECT site_id, 'connected_via_permissive_route' FROM decided WHERE status = 'permissive_access_evidenced'
        UNION SELECT site_id, 'permissive_access_may_be_withdrawn' FROM decided WHERE status = 'permissive_access_evidenced'
        UNION SELECT site_id, 'only_weak_or_permissive_connection' FROM decided WHERE status = 'uncertain' AND possible_access AND NOT default_access
        UNION SELECT site_id, 'no_evidenced_network_connection' FROM decided WHERE status = 'likely_access_island'
        UNION SELECT s.site_id, 'public_route_disconnected_from_roads' FROM decided s JOIN contact_flags f USING (site_id)
          WHERE s.status = 'likely_access_island' AND f.meets_safe""",
    "classified": """SELECT s.*, a.area_m2, a.name, a.area_ha,
          CASE s.status WHEN 'access_evidenced' THEN 'mapped_connection' WHEN 'permissive_access_evidenced' THEN 'mapped_permissive_connection'
            WHEN 'uncertain' THEN 'review_required' ELSE 'screening_candidate' END AS evidence_strength,
          coalesce((SELECT string_agg(reason, ';' ORDER BY reason) FROM final_notes n WHERE n.site_id = s.site_id), '') AS reasons
        FROM decided s JOIN sites a USING (site_id)""",
    # --- labels ---
    "council_part": """SELECT x.site_id, c.code, c.name, CAST(sum((least(xb, c.x1) - greatest(xa, c.x0)) * (least(yb, c.y1) - greatest(ya, c.y0))) AS BIGINT) AS overlap_m2
        FROM cells x JOIN councils c ON xa < c.x1 AND xb > c.x0 AND ya < c.y1 AND yb > c.y0 GROUP BY x.site_id, c.code, c.name""",
    "county_part": """SELECT x.site_id, c.code, c.name, CAST(sum((least(xb, c.x1) - greatest(xa, c.x0)) * (least(yb, c.y1) - greatest(ya, c.y0))) AS BIGINT) AS overlap_m2
        FROM cells x JOIN counties c ON xa < c.x1 AND xb > c.x0 AND ya < c.y1 AND yb > c.y0 GROUP BY x.site_id, c.code, c.name""",
    "council_labels": """SELECT site_id, first(code ORDER BY overlap_m2 DESC, code) AS council_code, first(name ORDER BY overlap_m2 DESC, code) AS council,
        string_agg(code, ';' ORDER BY overlap_m2 DESC, code) AS all_council_codes, string_agg(name, ';' ORDER BY overlap_m2 DESC, code) AS all_councils
        FROM council_part GROUP BY site_id""",
    "county_labels": """SELECT site_id, first(code ORDER BY overlap_m2 DESC, code) AS county_code, first(name ORDER BY overlap_m2 DESC, code) AS county,
        string_agg(code, ';' ORDER BY overlap_m2 DESC, code) AS all_county_codes, string_agg(name, ';' ORDER BY overlap_m2 DESC, code) AS all_counties
        FROM county_part GROUP BY site_id""",
    "labels_joined": """SELECT s.site_id, coalesce(u.council_code, '') AS council_code, coalesce(u.council, '') AS council,
          coalesce(u.all_council_codes, '') AS all_council_codes, coalesce(u.all_councils, '') AS all_councils,
          coalesce(c.all_county_codes, '') AS all_county_codes, coalesce(c.all_counties, '') AS all_counties,
          CASE WHEN coalesce(c.county, '') = '' THEN coalesce(u.council, '') ELSE c.county END AS county,
          CASE WHEN coalesce(c.county, '') = '' THEN coalesce(u.council_code, '') ELSE c.county_code END AS county_code
        FROM site_ids s LEFT JOIN council_labels u USING (site_id) LEFT JOIN county_labels c USING (site_id)""",
    "nearest": """SELECT m.site_id, min(d2) AS d2 FROM (
          SELECT m.site_id, greatest(0, m.x0 - r.x1, r.x0 - m.x1) ** 2 + greatest(0, m.y0 - r.y1, r.y0 - m.y1) ** 2 AS d2
          FROM member m JOIN routes r ON m.x0 - 6400 <= r.x1 AND m.x1 + 6400 >= r.x0 AND m.y0 - 6400 <= r.y1 AND m.y1 + 6400 >= r.y0) m
        GROUP BY m.site_id""",
    "points": """SELECT site_id, (x0 + x1) / 2.0 AS easting, (y0 + y1) / 2.0 AS northing FROM
        (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY (x1 - x0) * (y1 - y0) DESC, x0, y0) AS n FROM member) t WHERE n = 1""",
}

RECURSIVE = {"walk", "reach", "vwalk", "pwalk", "old_walk"}


def build(select: str, **extra: str) -> str:
    """The SELECT with every common table expression it refers to, in order of need."""
    known = {**CTE, **extra}
    order: list[str] = []

    def need(text: str, skip: str | None = None) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_0-9]+", re.sub(r"'[^']*'", "", text))):
            if word in known and word != skip and word not in order:
                need(known[word], word)
                if word not in order:
                    order.append(word)

    need(select)
    if not order:
        return select
    keyword = lambda name: "" if name in RECURSIVE else "MATERIALIZED "
    body = ",\n".join(f"{name} AS {keyword(name)}({known[name]})" for name in order)
    return f"WITH RECURSIVE {body}\n{select}"
