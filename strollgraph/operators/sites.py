"""Forming sites from land components, their dissolved outline and area, and identifiers.

Land: ``component_id, source_id, name, source_attributes, rings``.
A site is never held as one geometry: it is its components plus an outline table of straight
stretches, so a site that grows across the country stays spread over the cluster.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.functions import text as T
from strollgraph.operators import spatial as S
from strollgraph.operators.components import connected_components
from strollgraph.session import cut

MEMBER_CHUNKS = 64


@dataclass(frozen=True)
class Catalogue:
    """Sites and what they are made of.

    ``pieces`` (one component of every identical polygon) and their ``spans`` are the tables that the sites were formed from; later steps
    read them where they are kept and make them again where they are not.
    """

    sites: DataFrame
    membership: DataFrame
    outline: DataFrame
    components: DataFrame
    pieces: DataFrame | None = None
    spans: DataFrame | None = None


def collapse_copies(land: DataFrame) -> DataFrame:
    """Map every component to one representative of its identical polygon: ``component_id, rep``.

    A stack of copies then costs one edge per copy instead of one per pair.  Hashes only deal the
    rows; the rings themselves decide what is a copy.
    """
    shaped = land.select("component_id", F.xxhash64("rings").alias("shape"), "rings")
    hashed = shaped.drop("rings")
    # Rings move only where a hash occurs twice, and as a table of known size: the planner takes derived rings for a few bytes and would broadcast them.
    shared = hashed.groupBy("shape").agg(F.count("*").alias("n")).where("n > 1").select("shape")
    alone = hashed.join(shared, "shape", "left_anti").select("component_id", F.col("component_id").alias("rep"))
    twins = cut(shaped.join(shared, "shape", "left_semi"))
    key = ["shape", "rings"]
    least = twins.groupBy(*key).agg(F.min("component_id").alias("rep"))
    return alone.unionByName(twins.join(least, key).select("component_id", "rep"))


def touching_spans(a: DataFrame, b: DataFrame) -> DataFrame:
    """Stretches of outlines of ``a`` covered by other components in ``b`` (piece tables)."""
    return S.covered_spans(
        S.outline_segments(a, ["component_id"]),
        b.select("component_id", "edges", *S.BOUNDS),
        condition=F.col("a_component_id") != F.col("b_component_id"),
    ).select(
        F.col("a_component_id").alias("component_id"),
        F.col("a_s").alias("s"),
        F.col("b_component_id").alias("other_id"),
        "is_left", "t0", "t1",
    )


def touching_pairs(spans: DataFrame) -> DataFrame:
    """Unordered pairs sharing area or an edge; a common corner has no stretch and does not count."""
    return spans.select(
        F.least("component_id", "other_id").alias("a"), F.greatest("component_id", "other_id").alias("b")
    ).distinct()


def union_outline(pieces: DataFrame, spans: DataFrame) -> DataFrame:
    """Outline of the union of touching components: ``component_id, s`` (part of an original edge).

    A stretch goes when its outer side is covered by another component, or when a component
    with a smaller id has the same stretch with the same inner side.
    """
    hidden = spans.where(~F.col("is_left") | (F.col("other_id") < F.col("component_id")))
    free = S.uncovered_spans(
        hidden.select("component_id", "s", "t0", "t1"),
        S.outline_segments(pieces, ["component_id"]).select("component_id", "s", F.lit(0).alias("keep")),
        ["component_id", "s"],
    )
    return free.select("component_id", F.col("s").alias("edge"), F.expr(G.part_of("s", "t0", "t1")).alias("s"))


def outline_area(outline: DataFrame, key: str) -> DataFrame:
    return outline.groupBy(key).agg((F.sum(F.expr(G.edge_cross("s"))) / 2).alias("area_m2"))


def outline_hash(outline: DataFrame, key: str) -> DataFrame:
    """Hash of a dissolved shape that ignores vertex order and vertices on straight stretches.

    Both ends of a stretch enter an exclusive-or with its direction, so joints between collinear
    stretches cancel and only true corners remain.
    """
    length = G.edge_length("edge")
    corners = outline.select(
        key,
        F.expr(f"explode(array({G.point('s.x0', 's.y0')}, {G.point('s.x1', 's.y1')}))").alias("p"),
        F.expr(f"round((edge.x1 - edge.x0) / {length}, 6) + 0D").alias("ux"),
        F.expr(f"round((edge.y1 - edge.y0) / {length}, 6) + 0D").alias("uy"),
    )
    cell = [F.expr("round(p.x, 6) + 0D"), F.expr("round(p.y, 6) + 0D"), F.col("ux"), F.col("uy")]
    mixed = corners.groupBy(key).agg(
        *[F.bit_xor(F.xxhash64(F.lit(seed), *cell)).alias(f"h{seed}") for seed in range(4)]
    )
    return mixed.select(key, F.sha2(F.concat_ws(":", "h0", "h1", "h2", "h3"), 256).alias("geometry_sha256"))


def site_rollup(members: DataFrame, group: str, pieces: DataFrame | None = None) -> DataFrame:
    """Sorted-member id, names, sources and counts per group.

    Two levels of grouping: a hashed chunk of a site first, then the site.  The id digests the sorted list
    of all members, by one rule for every size, so the ids of one site (and nothing else) meet in one row.
    """
    chunk = F.pmod(F.xxhash64("component_id"), F.lit(MEMBER_CHUNKS))
    first = members.groupBy(group, chunk.alias("chunk")).agg(
        F.collect_list("component_id").alias("ids"),
        F.collect_set(F.nullif("name", F.lit(""))).alias("names"),
        F.collect_set("source_id").alias("sources"),
        F.count("*").alias("n"),
    )
    second = first.groupBy(group).agg(
        F.flatten(F.collect_list("ids")).alias("ids"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("sources"),
        F.sum("n").alias("component_count"),
    )
    site_id = T.site_id(F.col("ids"))
    return second.withColumn("site_id", site_id).select(
        group,
        "site_id",
        T.site_name(F.col("names"), F.col("site_id")).alias("name"),
        F.array_join("sources", ";").alias("source_ids"),
        F.size("sources").cast("bigint").alias("parcel_count"),
        "component_count",
    )


def form_sites(land: DataFrame) -> Catalogue:
    """Group touching components into sites with ids, names, counts and union area."""
    copies = cut(collapse_copies(land))
    unique = land.join(copies.where("component_id = rep").select("component_id"), "component_id", "left_semi")
    # Pieces and outline are read several times below, so both are made once.
    pieces = cut(S.polygon_pieces(unique.select("component_id", "rings")))
    spans = cut(touching_spans(pieces, pieces))
    roots = connected_components(touching_pairs(spans)).withColumnsRenamed({"node": "rep"})
    grouped = copies.join(roots, "rep", "left").select("component_id", F.coalesce("root", "rep").alias("root"))
    members = cut(land.select("component_id", "source_id", "name").join(grouped, "component_id"))
    rolled = site_rollup(members, "root")
    outline = cut(union_outline(pieces, spans).join(members.select("component_id", "root"), "component_id"))
    area = outline_area(outline, "root")
    shape = outline_hash(outline, "root")
    keyed = cut(rolled.join(area, "root").join(shape, "root"))
    ids = keyed.select("root", "site_id")
    return Catalogue(
        sites=keyed.select(
            "site_id", "name", "source_ids", "parcel_count", "component_count",
            (F.col("area_m2") / 10000).alias("area_ha"), "geometry_sha256",
        ),
        membership=members.join(ids, "root").select("site_id", "component_id"),
        outline=outline.join(ids, "root").select("site_id", "component_id", "edge", "s"),
        components=land,
        pieces=pieces,
        spans=spans,
    )


def site_shapes(membership: DataFrame, land: DataFrame) -> DataFrame:
    """Component polygons with the site as graph node, as piece rows.

    A site is a set of points, so identical polygons of one site enter once; they meet in a partial
    aggregate before the shuffle, which keeps a stack of copies out of every later join.
    """
    joined = membership.join(land.select("component_id", "rings"), "component_id")
    shaped = joined.select(
        F.col("site_id").alias("node"), F.xxhash64("rings").alias("_h"), "rings"
    )
    distinct = shaped.groupBy("node", "_h", "rings").agg(F.count("*").alias("_n"))
    return S.polygon_pieces(distinct.select("node", "rings"))


def catalogue_shapes(catalogue: Catalogue) -> DataFrame:
    """``site_shapes`` of a catalogue, from its kept pieces where it has them: identical polygons touch, so they are of one site."""
    if catalogue.pieces is None:
        return site_shapes(catalogue.membership, catalogue.components)
    node = catalogue.membership.select("component_id", F.col("site_id").alias("node"))
    return catalogue.pieces.join(node, "component_id").drop("component_id")
