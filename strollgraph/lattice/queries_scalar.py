"""Tag rules, text helpers, geometry measures and plain reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.functions import policy as P
from strollgraph.functions import text as X
from strollgraph.lattice import tables as T
from strollgraph.lattice.registry import query
from strollgraph.lattice.sqltext import policy
from strollgraph.operators import lineage as H
from strollgraph.operators import network as N
from strollgraph.operators import overlay as O
from strollgraph.operators import spatial as S
from strollgraph.plans import prepare as R
from strollgraph.sources import readers, writers

R6 = lambda c: F.round(c, 6).alias(c)

TAGGED_SQL = """
SELECT o_orderkey AS way_id,
  CASE o_custkey % 7 WHEN 0 THEN 'motorway' WHEN 1 THEN 'residential' WHEN 2 THEN 'primary_link' WHEN 3 THEN 'path'
    WHEN 4 THEN 'pedestrian' WHEN 5 THEN 'construction' ELSE 'footway' END AS highway,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'yes' WHEN '2-HIGH' THEN 'private' WHEN '3-MEDIUM' THEN 'permissive'
    WHEN '4-NOT SPECIFIED' THEN '' END AS foot,
  CASE CAST(FLOOR(o_totalprice) AS BIGINT) % 6 WHEN 0 THEN 'no' WHEN 1 THEN 'designated' WHEN 2 THEN 'permissive' ELSE '' END AS access,
  CASE o_orderstatus WHEN 'P' THEN 'public_footpath' END AS designation,
  CASE WHEN CAST(FLOOR(o_totalprice) AS BIGINT) % 11 = 0 THEN 'no @ (Mo)' ELSE '' END AS conditional,
  CASE WHEN o_custkey % 13 = 0 THEN '1' END AS layer, CASE WHEN o_custkey % 5 = 0 THEN 'yes' END AS bridge,
  CASE WHEN o_orderstatus = 'F' THEN 'stream' WHEN o_orderstatus = 'O' THEN 'canal' END AS waterway,
  CASE WHEN o_custkey % 3 = 0 THEN 'rail' END AS railway, o_custkey % 17 = 0 AS official
FROM orders
"""
AREAS_SQL = """
SELECT p_partkey AS feature_id, p_name AS name,
  CASE p_type WHEN 'SMALL' THEN 'water' WHEN 'MEDIUM' THEN 'wood' WHEN 'LARGE' THEN 'heath' END AS natural_tag,
  CASE p_size % 9 WHEN 0 THEN 'forest' WHEN 1 THEN 'basin' WHEN 2 THEN 'retail' WHEN 3 THEN 'common' WHEN 4 THEN 'residential' END AS landuse,
  CASE WHEN p_size % 4 = 0 THEN 'common' ELSE 'park' END AS leisure
FROM part
"""
LAW_SQL = "SELECT component_id, CASE WHEN supplemental THEN concat('section15:fid:', part_no) ELSE source_id END AS source_id, source_attributes FROM land"


def tag_map(**columns):
    """Map of the tags that are present."""
    pairs = [v for key, col in columns.items() for v in (F.lit(key.replace("__", ":")), F.col(col))]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())


def tagged_ways(x):
    rows = T.derive(x.spark, x.sf_dir, TAGGED_SQL, "orders")
    tags = tag_map(
        highway="highway", foot="foot", access="access", designation="designation", access__conditional="conditional",
        layer="layer", bridge="bridge", waterway="waterway", railway="railway",
    )
    return rows.withColumn("tags", tags)


def tagged_areas(x):
    rows = T.derive(x.spark, x.sf_dir, AREAS_SQL, "part")
    return rows.withColumn(
        "tags", tag_map(natural="natural_tag", landuse="landuse", leisure="leisure", name="name")
    )


def _policy(part):
    return policy(part, foot="coalesce(foot, '')", access="access", designation="coalesce(designation, '')",
                  official="official", cond="conditional <> ''")


@query(
    "b1_pedestrian_policy",
    f"SELECT way_id, {_policy('tier')} AS tier, {_policy('seed')} AS seed, {_policy('reason')} AS reason FROM tagged",
    tagged=TAGGED_SQL,
)
def _(x):
    return tagged_ways(x).select("way_id", P.pedestrian(F.col("tags"), F.col("official")).alias("v")).select(
        "way_id", "v.tier", "v.seed", "v.reason"
    )


@query("b2_barrier_blocks", "SELECT barrier_no, blocking FROM barriers")
def _(x):
    return x.barriers.select("barrier_no", "blocking")


@query(
    "b3_grade_key",
    "SELECT way_id, concat(coalesce(layer, '0'), ':', coalesce(bridge, 'no'), ':no') AS grade FROM tagged",
    tagged=TAGGED_SQL,
)
def _(x):
    return tagged_ways(x).select("way_id", P.grade(F.col("tags")).alias("grade"))


@query(
    "b4_common_tags", "SELECT feature_id, coalesce(leisure = 'common' OR landuse = 'common', false) AS is_common FROM tagged_areas",
    tagged_areas=AREAS_SQL,
)
def _(x):
    return tagged_areas(x).select("feature_id", P.is_common(F.col("tags")).alias("is_common"))


AREA_KIND = """CASE WHEN natural_tag = 'water' OR landuse IN ('reservoir', 'basin') THEN 'water' WHEN natural_tag = 'wood' OR landuse = 'forest' THEN 'woodland'
    WHEN natural_tag IN ('heath', 'scrub', 'grassland') THEN 'open_land' WHEN landuse IN ('residential', 'industrial', 'commercial', 'retail') THEN 'settlement' END"""
LINE_KIND = """CASE WHEN highway IN ('motorway', 'trunk', 'primary', 'secondary') OR highway LIKE '%\\_link' ESCAPE '\\' THEN 'major_road'
    WHEN highway IN ('tertiary', 'unclassified', 'residential', 'living_street', 'service') THEN 'minor_road'
    WHEN highway IN ('path', 'footway', 'bridleway', 'track', 'steps', 'cycleway') THEN 'path'
    WHEN waterway IN ('river', 'canal') THEN 'river' WHEN waterway = 'stream' THEN 'stream' WHEN railway = 'rail' THEN 'railway' END"""


@query("b5_area_kind", f"SELECT feature_id, {AREA_KIND} AS kind FROM tagged_areas", tagged_areas=AREAS_SQL)
def _(x):
    return tagged_areas(x).select("feature_id", P.area_kind(F.col("tags")).alias("kind"))


@query("b6_line_kind", f"SELECT way_id, {LINE_KIND} AS kind FROM tagged", tagged=TAGGED_SQL)
def _(x):
    return tagged_ways(x).select("way_id", P.line_kind(F.col("tags")).alias("kind"))


PLACES_SQL = """SELECT c_custkey AS feature_id, CASE c_mktsegment WHEN 'BUILDING' THEN 'town' WHEN 'MACHINERY' THEN 'village'
  WHEN 'FURNITURE' THEN 'hamlet' WHEN 'HOUSEHOLD' THEN 'city' END AS place, CASE WHEN c_acctbal < 0 THEN '' ELSE c_name END AS name FROM customer"""
FEATURES = f"""SELECT 'areas' AS layer, feature_id, {AREA_KIND} AS kind, name FROM tagged_areas WHERE {AREA_KIND} IS NOT NULL
    UNION ALL SELECT 'lines', way_id, {LINE_KIND}, '' FROM tagged WHERE {LINE_KIND} IS NOT NULL
    UNION ALL SELECT 'places', feature_id, place, name FROM place_nodes WHERE place IN ('city', 'town', 'village') AND name <> ''"""


def features(x):
    places = T.derive(x.spark, x.sf_dir, PLACES_SQL, "customer").withColumn("tags", tag_map(place="place", name="name"))
    lines = tagged_ways(x).select(F.col("way_id").alias("feature_id"), "tags")
    return R.context_features(tagged_areas(x), lines, places)


@query("p16_context_features", FEATURES, tagged_areas=AREAS_SQL, tagged=TAGGED_SQL, place_nodes=PLACES_SQL)
def _(x):
    return features(x)


@query(
    "d15_feature_kinds", "SELECT layer, kind, count(*) AS features FROM feature_rows GROUP BY layer, kind",
    feature_rows=FEATURES, tagged_areas=AREAS_SQL, tagged=TAGGED_SQL, place_nodes=PLACES_SQL,
)
def _(x):
    return R.kind_counts(features(x))


REGIMES = """coalesce(nullif(concat_ws(';', CASE WHEN common THEN 'registered_common_land' END, CASE WHEN oc THEN 'open_country' END,
    CASE WHEN s16 THEN 'section16_dedication' END, CASE WHEN source_id LIKE 'section15:%' THEN 'section15_statutory_access' END), ''), 'crow_access_land')"""
LAW_FLAGS = """SELECT *, source_attributes LIKE '%"rcl_oc": "rcl"%' AS common, source_attributes LIKE '%"OC": "Yes"%' AS oc,
    source_attributes LIKE '%"S16": "true"%' AS s16 FROM law"""


def law_land(x):
    source = F.when(F.col("supplemental"), F.concat(F.lit("section15:fid:"), "part_no")).otherwise(F.col("source_id"))
    return x.land.withColumn("source_id", source)


@query(
    "b7_legal_regimes",
    f"SELECT component_id, {REGIMES} AS access_regimes, common AS registered_common_land FROM law_flags",
    law_flags=LAW_FLAGS, law=LAW_SQL,
)
def _(x):
    return H.legal_metadata(law_land(x).select("component_id", "source_id", "source_attributes")).select(
        "component_id", "access_regimes", "registered_common_land"
    )


@query(
    "d11_site_regimes",
    """SELECT m.site_id, string_agg(DISTINCT u.regime, ';' ORDER BY u.regime) AS access_regimes, bool_or(l.common) AS registered_common_land
    FROM (SELECT site_id, component_id FROM member) m JOIN law_flags l USING (component_id)
    JOIN (SELECT component_id, unnest(string_split(%s, ';')) AS regime FROM law_flags) u USING (component_id) GROUP BY m.site_id""" % REGIMES,
    law_flags=LAW_FLAGS, law=LAW_SQL,
)
def _(x):
    return H.annotate_sites(x.catalogue.sites.select("site_id"), law_land(x), x.catalogue.membership).select(
        "site_id", "access_regimes", "registered_common_land"
    )


@query(
    "b8_list_fingerprint",
    """SELECT block, sha256('["' || string_agg(component_id, '", "' ORDER BY component_id) || '"]') AS fingerprint FROM land GROUP BY block""",
)
def _(x):
    return x.land.groupBy("block").agg(X.list_digest(F.collect_list("component_id")).alias("fingerprint"))


@query("b9_site_ids", "SELECT site_id, component_id FROM grouped JOIN site_ids USING (root)")
def _(x):
    members = x.catalogue.membership.groupBy("site_id").agg(F.collect_list("component_id").alias("c"))
    return members.select(X.site_id(F.col("c")).alias("site_id"), F.explode("c").alias("component_id"))


@query("b11_site_names", "SELECT site_id, name FROM sites")
def _(x):
    return x.catalogue.sites.select("site_id", "name")


@query(
    "b12_slugs",
    "SELECT page_id, coalesce(nullif(trim(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'region') AS slug FROM pages",
)
def _(x):
    return x.table("pages").select("page_id", X.slug(F.col("url")).alias("slug"))


@query(
    "b13_version_labels",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(make_timestamp((1700000000000 + event_id * 1000 + event_id % 2 * 250) * 1000), '%Y-%m-%dT%H:%M:%S')
      || CASE WHEN event_id % 2 = 0 THEN '' ELSE '.250000' END || '+00:00' WHEN 1 THEN event_type ELSE substr(sha256(event_type), 1, 12) END AS version_label FROM events""",
)
def _(x):
    n = F.col("event_id")
    millis = (F.lit(1700000000000) + n * 1000 + n % 2 * 250).cast("string")
    return x.table("events").select(
        "event_id",
        X.version_label(
            F.lit(""), F.when(n % 3 == 0, millis), F.when(n % 3 == 1, F.col("event_type")), F.sha2("event_type", 256)
        ).alias("version_label"),
    )


@query(
    "b14_attribute_json",
    """SELECT component_id, '{"OC":"' || (CASE WHEN l.source_attributes LIKE '%"OC": "Yes"%' THEN 'Yes' ELSE 'No' END) || '","S16":"' ||
      (CASE WHEN l.source_attributes LIKE '%"S16": "true"%' THEN 'true' ELSE '' END) || '","name":' || CASE WHEN l.name = '' THEN 'null' ELSE '"' || l.name || '"' END ||
      ',"rcl_oc":"' || (CASE WHEN l.source_attributes LIKE '%"rcl_oc": "rcl"%' THEN 'rcl' ELSE '' END) || '"}' AS attributes FROM land l""",
)
def _(x):
    name = F.when(F.col("name") == "", "NaN").otherwise(F.col("name"))
    attrs = F.map_concat(X.attributes_map(F.col("source_attributes")), F.create_map(F.lit("name"), name))
    return x.land.select("component_id", X.attributes_json(attrs).alias("attributes"))


@query(
    "b16_list_membership",
    """SELECT site_id, list_contains(string_split(all_council_codes, ';'), 'E3') AS in_e3, contains(all_councils, 'NATION_1') AS near_one FROM labels_joined""",
)
def _(x):
    return x.labelled.select(
        "site_id", X.in_list(F.col("all_council_codes"), "E3").alias("in_e3"),
        F.col("all_councils").contains("NATION_1").alias("near_one"),
    )


@query(
    "b17_tile_keys",
    """SELECT tx || ':' || ty AS tile, count(*) AS boxes FROM (SELECT unnest(generate_series(CAST(floor(x0 / 1000.0) AS BIGINT), CAST(floor(x1 / 1000.0) AS BIGINT))) AS tx, y0, y1 FROM hints) a,
    LATERAL (SELECT unnest(generate_series(CAST(floor(a.y0 / 1000.0) AS BIGINT), CAST(floor(a.y1 / 1000.0) AS BIGINT))) AS ty) b GROUP BY 1""",
)
def _(x):
    boxed = G.with_bounds(x.hints, "flatten(rings)").selectExpr(
        f"explode({G.tile_range('xmin', 'xmax', 1000.0)}) as tx", "ymin", "ymax"
    ).selectExpr("tx", f"explode({G.tile_range('ymin', 'ymax', 1000.0)}) as ty")
    return boxed.groupBy(F.concat_ws(":", "tx", "ty").alias("tile")).agg(F.count("*").alias("boxes"))


@query(
    "b18_box_measures",
    """SELECT component_id, CAST(x0 AS DOUBLE) AS xmin, CAST(y0 AS DOUBLE) AS ymin, CAST(x1 AS DOUBLE) AS xmax, CAST(y1 AS DOUBLE) AS ymax,
    CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS area_m2, CAST(2 * (x1 - x0) + 2 * (y1 - y0) AS DOUBLE) AS outline_m FROM land""",
)
def _(x):
    edges = S.whole_polygons(x.land.select("component_id", "rings"))
    return edges.selectExpr(
        "component_id", "xmin", "ymin", "xmax", "ymax", f"{G.signed_area('edges')} as area_m2",
        f"{G.edges_length('edges')} as outline_m",
    )


def multi_features(x):
    """Sources with several boxes as multipolygons, some of them without any or without area."""
    member = F.struct("component_id", F.when(F.col("part_no") % 10 >= 2, F.col("rings")).alias("rings"))
    return x.land.groupBy("source_id").agg(
        F.min("name").alias("name"), F.transform(F.array_sort(F.collect_list(member)), lambda m: m["rings"]).alias("polygons"),
        F.map_from_entries(F.array(F.struct(F.lit("kind"), F.min("source_attributes")))).alias("attributes"),
    )


GOOD = "SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY component_id) - 1 AS component FROM land WHERE part_no % 10 >= 2"


@query(
    "b21_multipart_explode",
    "SELECT source_id, CAST(component AS INTEGER) AS component, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS area_m2 FROM good_parts",
    good_parts=GOOD,
)
def _(x):
    return R.explode_polygons(multi_features(x), ["source_id"]).selectExpr(
        "source_id", "component", f"{G.polygon_area('rings')} as area_m2"
    )


@query(
    "b22_validity_gate",
    """SELECT outcome, count(*) AS components FROM (SELECT 'processed' AS outcome FROM good_parts UNION ALL
      SELECT 'rejected' FROM (SELECT source_id FROM land GROUP BY source_id HAVING bool_and(part_no % 10 < 2)) r) t GROUP BY outcome""",
    good_parts=GOOD,
)
def _(x):
    return R.accounting_counts(R.normalise_land(multi_features(x), None).accounting)


NEAR5 = """SELECT r.route_index, l.component_id, greatest(0, l.x0 - r.x1, r.x0 - l.x1) AS dx, greatest(0, l.y0 - r.y1, r.y0 - l.y1) AS dy,
    r.x0 AS rx0, r.y0 AS ry0, r.y1 AS ry1, l.y0 AS ly0, l.x0 AS lx0 FROM routes r JOIN land l ON l.x0 - 5 <= r.x1 AND l.x1 + 5 >= r.x0 AND l.y0 - 5 <= r.y1 AND l.y1 + 5 >= r.y0"""


def near_land(x):
    segments = S.path_segments(x.routes, ["route_index"]).drop("edge_no")
    pieces = S.polygon_pieces(x.land.select("component_id", "rings"))
    return S.link_distance(S.near_pairs(segments, pieces, 5.0), 5.0)


@query(
    "b23_line_area_distance",
    "SELECT route_index, component_id, sqrt(dx ** 2 + dy ** 2) AS distance FROM near5 WHERE dx ** 2 + dy ** 2 <= 25",
    near5=NEAR5,
)
def _(x):
    return near_land(x).selectExpr(
        "a_route_index as route_index", "b_component_id as component_id", "sqrt(link.d2) as distance"
    )


@query(
    "b24_shortest_lines",
    """SELECT route_index, component_id, CAST(rx0 AS DOUBLE) AS px, CAST(ry1 AS DOUBLE) AS py, CAST(rx0 AS DOUBLE) AS qx, CAST(ly0 AS DOUBLE) AS qy
    FROM near5 WHERE dx = 0 AND dy > 0 AND dy <= 5 AND ry1 > ry0""",
    near5=NEAR5,
)
def _(x):
    return near_land(x).where("link.d2 > 0").selectExpr(
        "a_route_index as route_index", "b_component_id as component_id", "link.px", "link.py", "link.qx", "link.qy"
    )


@query(
    "b25_line_area_lengths",
    """SELECT c.route_index, c.node AS site_id, CAST(sum(CASE WHEN low_side AND high_side THEN c.tb - c.ta ELSE 0 END) AS DOUBLE) AS inside_m,
      CAST(sum(CASE WHEN low_side <> high_side THEN c.tb - c.ta ELSE 0 END) AS DOUBLE) AS boundary_m,
      CAST(any_value(r.x1 - r.x0 + r.y1 - r.y0) - sum(c.tb - c.ta) AS DOUBLE) AS outside_m
    FROM whole_sides c JOIN routes r USING (route_index) GROUP BY c.route_index, c.node""",
    # A route on a tile seam has the same stretch in both tiles.
    whole_sides="SELECT DISTINCT node, route_index, ta, tb, low_side, high_side FROM cut_sides WHERE node LIKE 'site-%' AND (low_side OR high_side)",
)
def _(x):
    areas = x.site_shapes.withColumnRenamed("node", "site_id")
    return O.line_area_lengths(x.routes, "route_index", areas, "site_id").select(
        "route_index", "site_id", R6("inside_m"), R6("boundary_m"), R6("outside_m")
    )


@query(
    "b26_points_in_areas",
    "SELECT k.barrier_no, l.component_id FROM barriers k JOIN land l ON k.x BETWEEN l.x0 AND l.x1 AND k.y BETWEEN l.y0 AND l.y1",
)
def _(x):
    return O.points_in_areas(x.barriers, "barrier_no", S.polygon_pieces(x.land.select("component_id", "rings")), "component_id")


@query(
    "b26_covered_by",
    "SELECT l.component_id, c.code FROM land l JOIN councils c ON l.x0 >= c.x0 AND l.x1 <= c.x1 AND l.y0 >= c.y0 AND l.y1 <= c.y1",
)
def _(x):
    return O.covered_by(
        S.polygon_pieces(x.land.select("component_id", "rings")), "component_id",
        S.polygon_pieces(x.councils.select("code", "rings")), "code",
    )


@query(
    "b26_meets_boundary",
    "SELECT DISTINCT m.site_id AS node, c.code FROM member m JOIN councils c ON m.x0 <= c.x1 AND m.x1 >= c.x0 AND m.y0 <= c.y1 AND m.y1 >= c.y0",
)
def _(x):
    from strollgraph.operators.labels import meets_polygon

    return meets_polygon(x.site_shapes, x.councils, ["code"])


@query(
    "b27_within_distance",
    """SELECT r.route_index, l.component_id FROM routes r JOIN land l ON l.x0 - 30 <= r.x1 AND l.x1 + 30 >= r.x0 AND l.y0 - 30 <= r.y1 AND l.y1 + 30 >= r.y0
    WHERE greatest(0, l.x0 - r.x1, r.x0 - l.x1) ** 2 + greatest(0, l.y0 - r.y1, r.y0 - l.y1) ** 2 <= 900""",
)
def _(x):
    segments = S.path_segments(x.routes, ["route_index"]).drop("edge_no")
    pieces = S.polygon_pieces(x.land.select("component_id", "rings"))
    return S.link_distance(S.near_pairs(segments, pieces, 30.0), 30.0).selectExpr(
        "a_route_index as route_index", "b_component_id as component_id"
    )


@query(
    "b28_buffer_cover",
    """SELECT route_index, round(sum(greatest(0, tb - greatest(ta, coalesce(furthest, ta)))) / any_value(length_m), 6) AS covered FROM
    (SELECT *, max(tb) OVER (PARTITION BY route_index ORDER BY ta, tb ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS furthest FROM bands WHERE tb >= ta) t
    GROUP BY route_index""",
    bands="""SELECT s.route_index, s.x1 - s.x0 + s.y1 - s.y0 AS length_m,
      CASE WHEN s.y0 = s.y1 THEN greatest(0, e.x0 - s.x0 - sqrt(25 - greatest(0, e.y0 - s.y0, s.y0 - e.y1) ** 2)) ELSE greatest(0, e.y0 - s.y0 - sqrt(25 - greatest(0, e.x0 - s.x0, s.x0 - e.x1) ** 2)) END AS ta,
      CASE WHEN s.y0 = s.y1 THEN least(s.x1 - s.x0, e.x1 - s.x0 + sqrt(25 - greatest(0, e.y0 - s.y0, s.y0 - e.y1) ** 2)) ELSE least(s.y1 - s.y0, e.y1 - s.y0 + sqrt(25 - greatest(0, e.x0 - s.x0, s.x0 - e.x1) ** 2)) END AS tb
      FROM routes s JOIN routes e ON e.x0 - 5 <= s.x1 AND e.x1 + 5 >= s.x0 AND e.y0 - 5 <= s.y1 AND e.y1 + 5 >= s.y0 AND e.tier = 'inferred'
      WHERE s.tier <> 'inferred' AND s.x1 - s.x0 + s.y1 - s.y0 > 0""",
)
def _(x):
    segments = S.path_segments(x.routes.where("tier <> 'inferred'"), ["route_index"]).drop("edge_no")
    roads = S.path_segments(x.routes.where("tier = 'inferred'"), []).drop("edge_no")
    return O.within_buffers(segments, ["route_index"], roads, 5.0).select("route_index", R6("covered"))


@query("b30_county_fallback", "SELECT site_id, county, county_code FROM labels_joined")
def _(x):
    return x.labelled.select("site_id", "county", "county_code")


@query(
    "b32_site_search",
    """SELECT c.site_id, c.status FROM classified c JOIN labels_joined l USING (site_id) WHERE c.status IN ('uncertain', 'likely_access_island')
    AND (l.council = 'NATION_3' OR list_contains(string_split(l.all_councils, ';'), 'NATION_3')) AND lower(concat_ws(' ', c.name, c.site_id)) LIKE '%site-%a%'""",
)
def _(x):
    found = writers.search_sites(x.with_authorities(x.classified), ["uncertain", "likely_access_island"], council="NATION_3", text="SITE-")
    return found.where(F.col("site_id").substr(6, 16).contains("a") | F.lower("name").rlike("site-.*a")).select(
        "site_id", "status"
    )


@query("a2_box_read", "SELECT route_index, tier FROM routes WHERE x0 <= 9000 AND x1 >= 1000 AND y0 <= 2500 AND y1 >= -100")
def _(x):
    bounded = G.with_bounds(x.routes.select("route_index", "tier", "path"), "path")
    return S.within_bbox(bounded, (1000, -100, 9000, 2500)).select("route_index", "tier")


@query("a3_attribute_read", "SELECT code, name FROM councils WHERE code IN ('E1', 'E5', 'E24')")
def _(x):
    return x.councils.where(F.col("code").isin("E1", "E5", "E24")).select("code", "name")


@query("a4_pruned_read", "SELECT component_id, name FROM land")
def _(x):
    return x.land.select("component_id", "name")


@query("a5_tagged_ways", "SELECT way_id, waterway FROM tagged WHERE waterway IS NOT NULL OR railway IS NOT NULL", tagged=TAGGED_SQL)
def _(x):
    return readers.tagged(tagged_ways(x), "waterway", "railway").select("way_id", "waterway")


@query(
    "a14_id_completeness",
    """SELECT o_custkey AS id, 'missing' AS problem FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
    UNION ALL SELECT c_custkey, 'unexpected' FROM customer WHERE c_acctbal >= 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)""",
)
def _(x):
    asked = x.table("orders").select(F.col("o_custkey").alias("id"))
    got = x.table("customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("id"))
    return readers.id_completeness(asked, got, "id")


@query("f1_route_nodes", "SELECT node, route_index FROM (SELECT start_node AS node, route_index FROM routes WHERE start_node <> '' AND tier <> 'excluded' UNION ALL SELECT end_node, route_index FROM routes WHERE end_node <> '' AND tier <> 'excluded') t")
def _(x):
    return N.route_nodes(x.routes).select("node", "route_index")


@query("f3_union_by_name", "SELECT source_id, name, component_id, NULL AS access FROM land UNION ALL SELECT source_id, name, NULL, access FROM hints")
def _(x):
    return x.land.select("source_id", "name", "component_id").unionByName(
        x.hints.select("source_id", "name", "access"), allowMissingColumns=True
    )
