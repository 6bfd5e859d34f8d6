"""Lineage, reviews, report tables, joins between outputs and exports."""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import functions as F

from strollgraph.functions import text as X
from strollgraph.lattice.context import Lattice
from strollgraph.lattice.registry import query
from strollgraph.operators import labels as L
from strollgraph.operators import lineage as H
from strollgraph.operators import review as W
from strollgraph.operators import sites as D
from strollgraph.plans import analyse as A
from strollgraph.plans import export as E
from strollgraph.plans import region as Z
from strollgraph.plans import validate as V
from strollgraph.session import cut
from strollgraph.sources import writers

R6 = lambda c: F.round(c, 6).alias(c)

# Sites of the land without its supplemental part.
OLD = {
    "old_land": "SELECT * FROM land WHERE NOT supplemental",
    "old_walk": """SELECT component_id AS node, component_id AS root FROM old_land UNION SELECT t.b, w.root FROM old_walk w JOIN
      (SELECT a, b FROM old_touching UNION ALL SELECT b, a FROM old_touching) t ON t.a = w.node""",
    "old_touching": """SELECT a, b FROM touching WHERE a IN (SELECT component_id FROM old_land) AND b IN (SELECT component_id FROM old_land)""",
    "old_grouped": "SELECT node AS component_id, min(root) AS root FROM old_walk GROUP BY node",
    "old_ids": """SELECT root, concat('site-', substr(sha256('["' || string_agg(component_id, '", "' ORDER BY component_id) || '"]'), 1, 16)) AS previous_site_id
      FROM old_grouped GROUP BY root""",
    "old_member": "SELECT i.previous_site_id, l.* FROM old_grouped g JOIN old_ids i USING (root) JOIN land l USING (component_id)",
    "old_x": """SELECT previous_site_id, x AS xa, lead(x) OVER (PARTITION BY previous_site_id ORDER BY x) AS xb
      FROM (SELECT previous_site_id, x0 AS x FROM old_member UNION SELECT previous_site_id, x1 FROM old_member) t""",
    "old_y": """SELECT previous_site_id, y AS ya, lead(y) OVER (PARTITION BY previous_site_id ORDER BY y) AS yb
      FROM (SELECT previous_site_id, y0 AS y FROM old_member UNION SELECT previous_site_id, y1 FROM old_member) t""",
    "old_area": """SELECT x.previous_site_id, sum((xb - xa) * (yb - ya)) AS old_m2 FROM old_x x JOIN old_y y ON x.previous_site_id = y.previous_site_id AND xb IS NOT NULL AND yb IS NOT NULL
      WHERE EXISTS (SELECT 1 FROM old_member m WHERE m.previous_site_id = x.previous_site_id AND m.x0 <= xa AND m.x1 >= xb AND m.y0 <= ya AND m.y1 >= yb) GROUP BY x.previous_site_id""",
    "old_links": """SELECT DISTINCT m.site_id, o.previous_site_id FROM member m JOIN old_member o USING (component_id)""",
    "lineage": """SELECT l.previous_site_id, l.site_id AS formed_id, o.old_m2, a.area_m2, o.old_m2 = a.area_m2 AS same
      FROM old_links l JOIN old_area o USING (previous_site_id) JOIN site_area a USING (site_id)""",
    "kept_ids": """SELECT s.site_id AS formed_id, coalesce(min(CASE WHEN l.same THEN l.previous_site_id END), s.site_id) AS site_id
      FROM site_ids s LEFT JOIN lineage l ON l.formed_id = s.site_id GROUP BY s.site_id""",
}


class Extension:
    """Old catalogue without the supplement, and the catalogue grown by it."""

    def __init__(self, x: Lattice):
        self.x = x

    @cached_property
    def old(self) -> D.Catalogue:
        made = D.form_sites(self.x.land.where("not supplemental"))
        return replace(made, membership=cut(made.membership), outline=cut(made.outline))

    @cached_property
    def grown(self):
        return H.extend_sites(self.old, self.x.land.where("supplemental"))

    @cached_property
    def overlaps(self):
        grown, previous = self.grown
        return cut(H.site_overlaps(grown, self.old, previous.where("site_id = previous_site_id").select("site_id")))

    @cached_property
    def reconciled(self) -> H.Reconciled:
        return H.reconcile_ids(self.grown[0], self.old, self.overlaps)


def extension(x: Lattice) -> Extension:
    if not hasattr(x, "_extension"):
        x._extension = Extension(x)
    return x._extension


@query("h4_extended_sites", "SELECT site_id, name, parcel_count, component_count, area_ha FROM sites")
def _(x):
    return extension(x).grown[0].sites.select("site_id", "name", "parcel_count", "component_count", R6("area_ha"))


@query("c18_site_overlaps", "SELECT formed_id AS site_id, previous_site_id, CAST(old_m2 AS DOUBLE) AS overlap_m2 FROM lineage", **OLD)
def _(x):
    return extension(x).overlaps.select("site_id", "previous_site_id", R6("overlap_m2"))


@query(
    "h7_reconciled_ids",
    """SELECT l.previous_site_id, k.site_id, CASE WHEN l.same THEN 'unchanged_geometry' ELSE 'changed_geometry' END AS relationship,
      CAST(l.old_m2 AS DOUBLE) AS overlap_m2 FROM lineage l JOIN kept_ids k USING (formed_id)""",
    **OLD,
)
def _(x):
    return extension(x).reconciled.lineage.select("previous_site_id", "site_id", "relationship", R6("overlap_m2"))


@query(
    "p6_combined_catalogue",
    """SELECT k.site_id, s.component_count, s.area_ha FROM kept_ids k JOIN sites s ON s.site_id = k.formed_id""",
    **OLD,
)
def _(x):
    e = extension(x)
    annotated = H.combined_catalogue(e.grown[0], e.old, e.overlaps).sites
    return annotated.select("site_id", "component_count", R6("area_ha"))


@query("c16_replaced_membership", "SELECT k.site_id, m.component_id FROM kept_ids k JOIN member m ON m.site_id = k.formed_id", **OLD)
def _(x):
    e = extension(x)
    return H.replace_ids(e.grown[0].membership, e.reconciled.replacements)


@query(
    "a12_contact_evidence",
    "SELECT c.route_index AS route, c.distance, c.weak, c.node AS site_id, c.tier, r.source_id FROM contacts c JOIN routes r USING (route_index) WHERE c.node LIKE 'site-%'",
)
def _(x):
    return A.contact_evidence(x.graph.contacts, x.routes, x.classified)


@query(
    "c17_uncontacted_routes",
    "SELECT route_index, tier FROM routes WHERE route_index NOT IN (SELECT route_index FROM contacts)",
)
def _(x):
    return x.routes.select("route_index", "tier").join(x.graph.contacts, "route_index", "left_anti")


@query("a10_map_partitions", "SELECT site_id, CAST(floor(easting / 5000.0) AS BIGINT) || '_' || CAST(floor(northing / 5000.0) AS BIGINT) AS partition FROM points")
def _(x):
    return x.labelled.select("site_id", writers.partition_key(size=5000.0).alias("partition"))


MARKERS = """SELECT c.site_id, c.name, c.status, l.county, l.council,
      (SELECT coalesce(string_agg(DISTINCT u, ';' ORDER BY u), '') FROM (SELECT unnest(string_split(concat_ws(';', l.county, l.all_counties), ';')) AS u) q WHERE u <> '') AS counties,
      (SELECT coalesce(string_agg(DISTINCT u, ';' ORDER BY u), '') FROM (SELECT unnest(string_split(concat_ws(';', l.council, l.all_councils), ';')) AS u) q WHERE u <> '') AS councils,
      CAST(b.x0 AS DOUBLE) AS xmin, CAST(b.y0 AS DOUBLE) AS ymin, CAST(b.x1 AS DOUBLE) AS xmax, CAST(b.y1 AS DOUBLE) AS ymax, round(c.area_ha, 3) AS area, c.reasons,
      c.evidence_strength AS evidence, CAST(floor(p.easting / 50000.0) AS BIGINT) || '_' || CAST(floor(p.northing / 50000.0) AS BIGINT) AS partition
    FROM classified c JOIN labels_joined l USING (site_id) JOIN boxes b USING (site_id) JOIN points p USING (site_id)"""


@query("a11_site_markers", MARKERS)
def _(x):
    bounds = x.site_shapes.groupBy(F.col("node").alias("site_id")).agg(
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax")
    )
    return writers.site_markers(x.site_numbers, bounds)


# --- samples and reviews ---


@query(
    "e1_top_per_status",
    "SELECT site_id, status, area_ha FROM (SELECT *, row_number() OVER (PARTITION BY status ORDER BY area_ha DESC, site_id) AS n FROM classified) t WHERE n <= 10",
)
def _(x):
    return W.top_per_status(x.site_numbers).select("site_id", "status", "area_ha")


@query(
    "e6_candidate_list",
    """SELECT site_id, area_ha, row_number() OVER (ORDER BY area_ha DESC, site_id) AS map_number FROM classified WHERE status = 'likely_access_island'
    ORDER BY area_ha DESC, site_id LIMIT 25""",
)
def _(x):
    return W.candidate_list(x.site_numbers).select("site_id", "area_ha", "map_number")


@query(
    "p14_report_rows",
    """SELECT 'status_counts' AS part, status AS item, count(*) AS value FROM classified GROUP BY status
    UNION ALL SELECT 'candidates', site_id, map_number FROM (SELECT site_id, row_number() OVER (ORDER BY area_ha DESC, site_id) AS map_number
      FROM classified WHERE status = 'likely_access_island' ORDER BY area_ha DESC, site_id LIMIT 25)""",
)
def _(x):
    tables = E.report_tables(x.status_numbers)
    counts = tables["status_counts"].select(F.lit("status_counts").alias("part"), F.col("status").alias("item"), F.col("sites").alias("value"))
    return counts.unionByName(tables["candidates"].select(F.lit("candidates").alias("part"), F.col("site_id").alias("item"), F.col("map_number").alias("value")))


@query("e9_output_order", "SELECT site_id, component_id FROM member ORDER BY site_id, component_id")
def _(x):
    return x.catalogue.membership.orderBy("site_id", "component_id")


# A review counts for the current shape unless its notes ask otherwise; 'old' marks an earlier shape.
EARLIER = """SELECT m.site_id, r.review_outcome, r.review_notes FROM reviews r JOIN member m USING (component_id)"""
ONE = """SELECT site_id, review_outcome, review_notes FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY review_outcome, review_notes) AS n FROM earlier) t WHERE n = 1"""


def earlier_reviews(x):
    rows = x.reviews.join(x.catalogue.membership, "component_id").join(
        x.catalogue.sites.select("site_id", "geometry_sha256"), "site_id"
    )
    sha = F.when(F.col("review_notes") == "", F.col("geometry_sha256")).otherwise("old")
    return rows.select(
        "site_id", sha.alias("geometry_sha256"), "review_outcome", "review_notes",
        F.lit("").alias("review_source"), F.lit("").alias("review_date"),
    )


@query(
    "c20_review_sample",
    """SELECT c.site_id, coalesce(v.review_outcome, '') AS review_outcome, 'map/index.html?site=' || c.site_id AS map_link
    FROM (SELECT *, row_number() OVER (PARTITION BY status ORDER BY area_ha DESC, site_id) AS n FROM classified) c
    LEFT JOIN (SELECT * FROM one_review WHERE review_notes = '') v USING (site_id) WHERE n <= 10 OR coalesce(v.review_outcome, '') <> ''""",
    earlier=EARLIER, one_review=ONE,
)
def _(x):
    sample, _lost = W.carry_reviews(x.site_numbers, earlier_reviews(x))
    return sample.select("site_id", "review_outcome", "map_link")


@query("f5_review_history", "SELECT site_id, review_outcome, review_notes FROM one_review WHERE review_notes <> ''", earlier=EARLIER, one_review=ONE)
def _(x):
    _sample, lost = W.carry_reviews(x.site_numbers, earlier_reviews(x))
    lost = lost.select("site_id", "review_outcome", "review_notes")
    return W.append_history(lost, lost)


@query(
    "c23_desk_reviews",
    """SELECT count(DISTINCT site_id) AS reviewed FROM (SELECT site_id FROM earlier WHERE review_notes = ''
      UNION SELECT site_id FROM one_review WHERE review_notes = '' AND review_outcome <> '') t""",
    earlier=EARLIER, one_review=ONE,
)
def _(x):
    desk = W.desk_reviews(earlier_reviews(x), x.catalogue.sites)
    sample, _lost = W.carry_reviews(x.status_numbers, earlier_reviews(x))
    return W.reviewed_sites(desk, sample).agg(F.count("*").alias("reviewed"))


# --- report tables ---

IN_CORE = "list_contains(string_split(l.all_county_codes, ';'), 'C1')"


@query(
    "d7_core_table",
    f"""SELECT coalesce(c.status, 'total') AS status, CAST(sum(CASE WHEN {IN_CORE} THEN 1 ELSE 0 END) AS BIGINT) AS core,
      CAST(sum(CASE WHEN {IN_CORE} THEN 0 ELSE 1 END) AS BIGINT) AS surrounding FROM classified c JOIN labels_joined l USING (site_id) GROUP BY ROLLUP (c.status)""",
)
def _(x):
    return W.core_table(x.labelled.withColumn("in_core", X.in_list(F.col("all_county_codes"), "C1")))


@query(
    "d8_run_summary",
    """SELECT count(*) AS sites, round(sum(s.area_m2) / 10000.0, 4) AS area_ha, count(*) FILTER (WHERE q.common) AS registered_common_sites,
      count(*) FILTER (WHERE q.supplement) AS section15_sites, count(*) FILTER (WHERE s.area_m2 < 1500) AS very_small_sites, CAST(0 AS BIGINT) AS edge_unresolved_sites
    FROM sites s JOIN (SELECT site_id, bool_or(source_attributes LIKE '%"rcl_oc": "rcl"%') AS common, bool_or(supplemental) AS supplement FROM member GROUP BY site_id) q USING (site_id)""",
)
def _(x):
    from strollgraph.lattice.queries_scalar import law_land

    sites = H.annotate_sites(x.site_numbers, law_land(x), x.catalogue.membership)
    return W.run_summary(sites, x.settings.min_candidate_area_m2)


@query(
    "d14_area_index",
    """SELECT slug, name, completed, sites FROM (SELECT concat('area-', user_id) AS slug, event_type AS name, ts AS completed, event_id AS sites,
      row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC, event_id DESC) AS n FROM events) t WHERE n = 1""",
)
def _(x):
    runs = x.table("events").select(
        F.concat(F.lit("area-"), "user_id").alias("slug"), F.col("event_type").alias("name"),
        F.col("ts").alias("completed"), F.col("event_id").alias("sites"),
    )
    return W.area_index(runs)


@query(
    "p14_report_tables",
    """SELECT status, county, count(*) AS sites, round(sum(area_m2) / 10000.0, 4) AS area_ha FROM classified c JOIN labels_joined l USING (site_id) GROUP BY status, county""",
)
def _(x):
    return x.with_authorities(x.status_numbers).groupBy("status", "county").agg(
        F.count("*").alias("sites"), F.round(F.sum("area_ha"), 4).alias("area_ha")
    )


# --- checks ---


@query(
    "c19_id_agreement",
    """SELECT coalesce(a.route_index, b.route_index) AS route_index, CASE WHEN b.route_index IS NULL THEN 'left' ELSE 'right' END AS side
    FROM (SELECT DISTINCT route_index FROM contacts) a FULL JOIN seeds b ON a.route_index = b.route_index WHERE a.route_index IS NULL OR b.route_index IS NULL""",
)
def _(x):
    return V.id_mismatch(x.graph.contacts, x.graph.seeds, "route_index")


@query("f2_distinct_edges", "SELECT DISTINCT a, b FROM edges UNION SELECT DISTINCT node, reason FROM notes")
def _(x):
    return x.graph.edges.select("a", "b").union(x.graph.notes.select("node", "reason")).distinct()


@query("f4_set_difference", "SELECT node FROM (SELECT node FROM kinds WHERE kind = 'site' EXCEPT SELECT node FROM contacts) t")
def _(x):
    return x.graph.kinds.where("kind = 'site'").select("node").subtract(x.graph.contacts.select("node"))


@query(
    "p13_run_checks",
    """SELECT 'membership_ids' AS "check", count(*) FILTER (WHERE site_id NOT IN (SELECT site_id FROM member)) AS violations FROM classified
    UNION ALL SELECT 'catalogue_ids', count(*) FILTER (WHERE site_id NOT IN (SELECT site_id FROM sites)) FROM classified
    UNION ALL SELECT 'repeated_ids', count(*) - count(DISTINCT site_id) FROM classified
    UNION ALL SELECT 'points_outside', count(*) FROM points p WHERE NOT EXISTS (SELECT 1 FROM member m WHERE m.site_id = p.site_id AND p.easting BETWEEN m.x0 AND m.x1 AND p.northing BETWEEN m.y0 AND m.y1)""",
)
def _(x):
    run = x.classified.join(L.site_points(x.site_shapes), "site_id", "left")
    return V.validate_run(run, x.catalogue.membership, x.catalogue.sites, x.site_shapes)


@query(
    "c22_reported_sites",
    """SELECT site_id FROM labels_joined WHERE list_contains(string_split(all_council_codes, ';'), 'E3') AND site_id IN
      (SELECT site_id FROM member WHERE x0 <= 20000 AND x1 >= 0 AND y0 <= 100000 AND y1 >= 20)""",
)
def _(x):
    codes = Z.authority_table(x.counties, x.councils)
    sites = x.with_authorities(x.catalogue.sites)
    shown = Z.report_filter(sites, x.site_shapes, codes, "E3", (0.0, 20.0, 20000.0, 100000.0), x.catalogue.sites)
    return shown.select("site_id")
