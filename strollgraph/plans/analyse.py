"""The screening run: graph, reachability, status, labels and evidence."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strollgraph.functions import policy as P
from strollgraph.operators import classify as K
from strollgraph.operators import labels as L
from strollgraph.operators import lineage as H
from strollgraph.operators import network as N
from strollgraph.operators import sites as D
from strollgraph.operators import spatial as S
from strollgraph.plans.region import report_filter
from strollgraph.session import cut
from strollgraph.sources.readers import source_versions


@dataclass(frozen=True)
class Settings:
    tolerance_m: float = 2.0
    tile_size_m: float = 20000.0
    min_candidate_area_m2: float = 100.0
    nearest_limit_m: float = L.NEAREST_LIMIT_M
    country: str = "England"

    def __post_init__(self):
        if not self.tolerance_m >= 0 or not self.tile_size_m >= 100:
            raise ValueError("Tolerance must not be negative and tiles must be at least 100 m")
        if not math.isfinite(self.min_candidate_area_m2) or self.min_candidate_area_m2 < 0:
            raise ValueError("The smallest candidate area must be finite and not negative")

    @property
    def relaxed_m(self) -> float:
        return max(5.0, self.tolerance_m)


@dataclass(frozen=True)
class Inputs:
    """Everything one run reads.  ``hints`` and ``gaps`` may be left out."""

    catalogue: D.Catalogue
    routes: DataFrame
    barriers: DataFrame
    counties: DataFrame | None = None
    councils: DataFrame | None = None
    gaps: DataFrame | None = None
    hints: DataFrame | None = None
    unmapped: bool = False
    boundary_nodes: DataFrame | None = None
    sources: DataFrame | None = None  # role, version, last_modified, sha256


@dataclass(frozen=True)
class Report:
    """Which sites a run reports: those of an authority code, in a box, of a region's list; all of them if nothing is given."""

    authority: str | None = None
    box: tuple[float, float, float, float] | None = None
    region_sites: DataFrame | None = None


@dataclass(frozen=True)
class Graph:
    shapes: DataFrame
    site_shapes: DataFrame
    kinds: DataFrame
    contacts: DataFrame
    edges: DataFrame
    seeds: DataFrame
    notes: DataFrame
    hint_links: DataFrame | None = field(default=None)


def walkable(hints: DataFrame) -> DataFrame:
    """Hints that may carry possible connections; private ones stay display clues."""
    tags = F.create_map(F.lit("foot"), F.col("foot"), F.lit("access"), F.col("access"))
    return hints.where(P.pedestrian(tags)["tier"] != "excluded")


def graph_shapes(catalogue: D.Catalogue, hints: DataFrame | None) -> DataFrame:
    """Site components and walkable hints as pieces with their graph node."""
    sites = D.catalogue_shapes(catalogue).select(
        "node", F.lit(True).alias("official_site"), "edges", "whole", *S.BOUNDS
    )
    if hints is None:
        return sites
    pieces = S.polygon_pieces(walkable(hints).select(F.col("site_id").alias("node"), "rings"))
    return sites.unionByName(pieces.select("node", F.lit(False).alias("official_site"), "edges", "whole", *S.BOUNDS))


def node_kinds(routes: DataFrame, sites: DataFrame, hints: DataFrame | None) -> DataFrame:
    kinds = routes.select(N.route_node("route_index").alias("node"), F.col("tier").alias("kind")).unionByName(
        sites.select(F.col("site_id").alias("node"), F.lit("site").alias("kind"))
    )
    if hints is None:
        return kinds
    return kinds.unionByName(walkable(hints).select(F.col("site_id").alias("node"), F.lit("hint").alias("kind")))


def build_graph(inputs: Inputs, settings: Settings, shapes: DataFrame | None = None) -> Graph:
    """The graph of a run; ``shapes`` are the stored ``graph_shapes`` of the inputs where they were made before."""
    reach = settings.relaxed_m
    if shapes is None:
        shapes = cut(graph_shapes(inputs.catalogue, inputs.hints))
    contacts = cut(
        N.tile_contacts(shapes, inputs.routes, inputs.barriers, reach, settings.tile_size_m, cut)
    )
    nearby = cut(N.nearby_shapes(shapes, reach))
    edges = (
        N.node_edges(inputs.routes, inputs.barriers)
        .unionByName(N.snap_edges(inputs.routes, inputs.barriers, reach))
        .unionByName(N.contact_edges(contacts))
        .unionByName(N.nearby_edges(nearby))
    )
    notes = N.contact_notes(contacts).unionByName(N.nearby_notes(nearby))
    official = shapes.where("official_site")
    hint_links = None
    if inputs.hints is not None:
        hint_links = cut(L.nearby_hints(official, inputs.hints, reach))
        notes = notes.unionByName(
            hint_links.select(F.col("site_id").alias("node"), F.lit("unverified_osm_common_nearby").alias("reason"))
        )
    return Graph(
        shapes=shapes,
        site_shapes=official,
        kinds=node_kinds(inputs.routes, inputs.catalogue.sites, inputs.hints),
        contacts=N.strongest_contacts(contacts),
        edges=edges,
        seeds=N.seed_routes(inputs.routes, shapes),
        notes=notes.distinct(),
        hint_links=hint_links,
    )


def uncovered_sites(inputs: Inputs, site_shapes: DataFrame) -> DataFrame:
    """Sites that meet an area without official coverage; all of them when gaps cannot be mapped."""
    if inputs.unmapped:
        return inputs.catalogue.sites.select("site_id")
    if inputs.gaps is None:
        return inputs.catalogue.sites.select("site_id").where(F.lit(False))
    return L.meets_polygon(site_shapes, inputs.gaps, ["code"]).select(F.col("node").alias("site_id")).distinct()


def classify(inputs: Inputs, graph: Graph, settings: Settings) -> DataFrame:
    """Sites with the variant columns, status, strength and reasons."""
    chosen = K.variants(settings.tolerance_m)
    seeds = cut(K.variant_seeds(graph.seeds, graph.kinds, chosen))
    # Only these nodes are looked up below: the sites, the seeds and the nodes at the edge of the context.
    asked = inputs.catalogue.sites.select(F.col("site_id").alias("node")).unionByName(seeds.select("node"))
    if inputs.boundary_nodes is not None:
        asked = asked.unionByName(inputs.boundary_nodes.select("node"))
    roots = K.variant_roots(graph.edges, graph.kinds, chosen, asked)
    notes = graph.notes
    if inputs.boundary_nodes is not None:
        notes = notes.unionByName(K.edge_notes(roots, inputs.boundary_nodes)).distinct()
    sites = inputs.catalogue.sites.withColumn("area_m2", F.col("area_ha") * 10000)
    reach = K.reach_table(sites, roots, seeds, chosen)
    decided = K.decide(
        reach, notes, graph.contacts, uncovered_sites(inputs, graph.site_shapes), settings.min_candidate_area_m2
    )
    return decided.drop("area_m2", "possible_access")


def authority_labels(catalogue: D.Catalogue, site_shapes: DataFrame, counties: DataFrame, councils: DataFrame) -> tuple[DataFrame, DataFrame]:
    """County and council labels per site; they follow from the catalogue and the boundaries alone."""
    labels = lambda areas, *names: L.boundary_labels(L.overlay_areas(site_shapes, catalogue.outline, areas), areas, *names)
    return labels(counties, "county", "all_counties"), labels(councils, "council", "all_councils")


def label(
    sites: DataFrame, inputs: Inputs, graph: Graph, settings: Settings, report: Report = Report(),
    labels: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Add legal regimes and authority labels, keep the reported sites, and add to them nearest route, hints, the representative point and provenance.

    The wide searches come last, so they follow the reported sites.  ``labels`` are the stored ``authority_labels`` where they were made before.
    """
    sites = H.annotate_sites(sites, inputs.catalogue.components, inputs.catalogue.membership)
    authorities = None
    if inputs.counties is not None and inputs.councils is not None:
        authorities = inputs.counties.select("code").unionByName(inputs.councils.select("code")).distinct()
        sites = L.add_labels(sites, *(labels or authority_labels(inputs.catalogue, graph.site_shapes, inputs.counties, inputs.councils)))
    shapes = graph.site_shapes
    if report != Report():
        if report.authority is not None and authorities is None:
            raise ValueError("Reporting one authority needs the county and council layers")
        sites = cut(report_filter(sites, shapes, authorities, report.authority, report.box, report.region_sites))
        shapes = shapes.join(sites.select(F.col("site_id").alias("node")), "node", "left_semi")
    sites = sites.join(L.nearest_routes(shapes, inputs.routes, settings.nearest_limit_m), "site_id", "left").join(
        L.site_points(shapes), "site_id", "left"
    )
    if graph.hint_links is None:
        sites = sites.withColumn("unverified_common_ids", F.lit(""))
    else:
        sites = sites.join(graph.hint_links, "site_id", "left").withColumn(
            "unverified_common_ids", F.coalesce("unverified_common_ids", F.lit(""))
        )
    if inputs.sources is not None:
        sites = sites.crossJoin(F.broadcast(source_versions(inputs.sources)))  # one row
    return sites.withColumn("country", F.lit(settings.country))


def contact_evidence(contacts: DataFrame, routes: DataFrame, sites: DataFrame) -> DataFrame:
    """Contacts of the reported sites with tier and source of the route."""
    return (
        contacts.withColumnRenamed("node", "site_id")
        .join(sites.select("site_id"), "site_id", "left_semi")
        .join(routes.select("route_index", "source_id"), "route_index")
        .select(F.col("route_index").alias("route"), "distance", "weak", "site_id", "tier", "source_id")
    )


@dataclass(frozen=True)
class Result:
    """What a run publishes, for the reported sites only, and its graph."""

    sites: DataFrame
    contacts: DataFrame
    graph: Graph
    membership: DataFrame
    route_evidence: DataFrame


def analyse(inputs: Inputs, settings: Settings | None = None, report: Report = Report()) -> Result:
    """The whole run on one set of inputs.

    All sites take part in the graph and are classified; labels, distances, membership and contacts are given for the reported ones.
    """
    settings = settings or Settings()
    graph = build_graph(inputs, settings)
    decided = classify(inputs, graph, settings)
    sites = cut(label(cut(decided), inputs, graph, settings, report))
    contacts = contact_evidence(graph.contacts, inputs.routes, sites)
    used = contacts.select(F.col("route").alias("route_index")).distinct()
    return Result(
        sites=sites, contacts=contacts, graph=graph,
        membership=inputs.catalogue.membership.join(sites.select("site_id"), "site_id", "left_semi"),
        route_evidence=inputs.routes.join(used, "route_index", "left_semi"),
    )
