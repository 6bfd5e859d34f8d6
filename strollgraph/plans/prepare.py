"""Preparing land, boundaries, routes, barriers, hints and context features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.functions import policy as P
from strollgraph.functions import text as T
from strollgraph.operators import overlay as O
from strollgraph.operators import spatial as S

MIN_RING_VERTICES = 4
WAY_CHUNK = 1024


@dataclass(frozen=True)
class PreparedLand:
    land: DataFrame
    accounting: DataFrame
    rejected: DataFrame


def usable_polygons(polygons: str) -> Column:
    """Parts of a multipolygon with a closed outer ring and an area."""
    area = G.signed_area(G.path_edges("pg[0]"))
    test = f"pg is not null and size(pg) > 0 and size(pg[0]) >= {MIN_RING_VERTICES} and abs({area}) > 0"
    return F.expr(f"filter(coalesce({polygons}, cast(array() as array<{G.RINGS}>)), pg -> {test})")


def explode_polygons(features: DataFrame, keep: list[str]) -> DataFrame:
    """One row per usable polygon of a multipolygon: kept columns, ``component``, ``rings``."""
    return features.select(*keep, F.posexplode(usable_polygons("polygons")).alias("component", "rings"))


def explode_lines(features: DataFrame, keep: list[str]) -> DataFrame:
    """One row per line part with a length: kept columns, ``part_no``, ``path``."""
    kept = f"filter(coalesce(lines, cast(array() as array<{G.PATH}>)), ln -> {G.path_length('ln')} > 0)"
    return features.select(*keep, F.expr(f"posexplode({kept}) as (part_no, path)"))


def normalise_land(
    features: DataFrame, country: DataFrame | None, superseded: bool = False
) -> PreparedLand:
    """Land components clipped to the country, with an outcome for every source part.

    ``features``: ``source_id, name, attributes (map), polygons (array of rings)``.  With
    ``superseded`` the layer is only accounted for, since the primary layer already contains it.
    """
    counted = features.withColumn("usable", usable_polygons("polygons"))
    bad = counted.where(F.size("usable") == 0)
    parts = counted.select(
        "source_id", "name", "attributes", F.posexplode("usable").alias("component", "rings")
    ).withColumn("part_id", F.concat_ws(":", "source_id", "component"))
    reject_rows = bad.select("source_id", F.lit(0).alias("component"), F.lit("rejected").alias("outcome"))
    rejected = bad.select("source_id", F.lit("no_polygon_geometry").alias("reason"))
    if superseded:
        note = parts.select("source_id", "component", F.lit("superseded_by_current_access_layer").alias("outcome"))
        empty = parts.where(F.lit(False))
        land = empty.select(
            F.col("part_id").alias("component_id"), "source_id", "name",
            F.lit("").alias("source_attributes"), "rings",
        )
        return PreparedLand(land, note.unionByName(reject_rows), rejected)
    if country is None:
        clipped = parts.select("part_id", F.lit(0).alias("part_no"), "rings")
    else:
        clipped = O.clip_polygons(parts.select("part_id", "rings"), "part_id", country)
    land = clipped.join(parts.drop("rings"), "part_id").select(
        F.concat_ws(":", "part_id", "part_no").alias("component_id"),
        "source_id",
        F.coalesce("name", F.lit("")).alias("name"),
        T.attributes_json(F.col("attributes")).alias("source_attributes"),
        "rings",
    )
    kept = clipped.select("part_id").distinct().withColumn("kept", F.lit(True))
    outcome = F.when(F.col("kept"), "processed").otherwise("outside_england")
    accounting = parts.join(kept, "part_id", "left").select("source_id", "component", outcome.alias("outcome"))
    return PreparedLand(land, accounting.unionByName(reject_rows), rejected)


def accounting_counts(accounting: DataFrame) -> DataFrame:
    return accounting.groupBy("outcome").agg(F.count("*").alias("components"))


def normalise_boundary(frame: DataFrame, code_field: str | None = None, name_field: str | None = None) -> DataFrame:
    """Boundary layer as ``code, name, rings``; fields ending in CD and NM are found by name."""

    def pick(given: str | None, suffix: str) -> str | None:
        return given or next((c for c in frame.columns if c.upper().endswith(suffix)), None)

    code, name = pick(code_field, "CD"), pick(name_field, "NM")
    if not code or not name:
        raise ValueError(f"Set code_field and name_field; fields are {frame.columns}")
    result = frame.select(F.col(code).alias("code"), F.col(name).alias("name"), "rings")
    usable = F.coalesce(F.expr(f"size(rings) > 0 and {G.polygon_area('rings')} > 0"), F.lit(False))
    twice = result.groupBy("code").agg(F.count("*").alias("n")).where("n > 1")
    if not result.where(~usable).isEmpty() or not twice.isEmpty():
        raise ValueError("Boundary layer has empty shapes or repeated codes")
    return result


def coverage_gaps(layers: list[DataFrame], missing: DataFrame, replaced: list[str] | None = None):
    """Boundaries of authorities without official routes, and the missing codes found in no layer."""
    rows = layers[0].select("code", "name", "rings")
    for layer in layers[1:]:
        rows = rows.unionByName(layer.select("code", "name", "rings"))
    gaps = rows.join(missing, "code", "left_semi").dropDuplicates(["code"])
    if replaced:
        gaps = gaps.where(~F.col("code").isin(replaced))
    unmapped = missing.select("code").distinct().join(rows.select("code"), "code", "left_anti")
    return gaps, unmapped


# --- tagged ways ---------------------------------------------------------------------------------


def junctions(way_nodes: DataFrame) -> DataFrame:
    """Nodes used more than once, repeats within one way included."""
    return way_nodes.groupBy("node_id").agg(F.count("*").alias("uses")).where("uses > 1")


def running_count(df: DataFrame, key: str, pos: str, flag: str, out: str) -> DataFrame:
    """Flags strictly before a position, counted in chunks so that one long way stays spread out."""
    chunked = df.withColumn("_chunk", F.floor(F.col(pos) / WAY_CHUNK))
    within = Window.partitionBy(key, "_chunk").orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = chunked.groupBy(key, "_chunk").agg(F.sum(F.col(flag).cast("bigint")).alias("_n"))
    offsets = totals.select(key, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = F.coalesce(F.sum(F.col(flag).cast("bigint")).over(within), F.lit(0))
    return (
        chunked.withColumn("_local", local)
        .join(offsets, [key, "_chunk"])
        .withColumn(out, F.col("_local") + F.col("_offset"))
        .drop("_local", "_offset", "_chunk")
    )


def split_ways(way_nodes: DataFrame, nodes: DataFrame, barrier_nodes: DataFrame) -> DataFrame:
    """Way parts between junctions, barrier nodes and ends: ``way_id, seg_no, end_pos, start_node, end_node, path``.

    ``way_nodes``: ``way_id, pos (from 0), node_id``; ``nodes``: ``node_id, x, y``.  A part without two
    different coordinates is dropped.
    """
    lengths = way_nodes.groupBy("way_id").agg(F.max("pos").alias("last_pos")).where("last_pos >= 1")
    cuts = junctions(way_nodes).select("node_id").unionByName(barrier_nodes.select("node_id")).distinct()
    rows = (
        way_nodes.join(lengths, "way_id")
        .join(cuts.withColumn("is_cut", F.lit(True)), "node_id", "left")
        .join(nodes.select("node_id", "x", "y"), "node_id", "left")
        .withColumn("ends", (F.col("pos") > 0) & (F.coalesce("is_cut", F.lit(False)) | (F.col("pos") == F.col("last_pos"))))
    )
    numbered = running_count(rows, "way_id", "pos", "ends", "seg_no")
    opens_next = F.col("ends") & (F.col("pos") < F.col("last_pos"))
    vertices = numbered.select(
        "way_id", "pos", "node_id", "x", "y",
        F.explode(F.when(opens_next, F.array("seg_no", F.col("seg_no") + 1)).otherwise(F.array("seg_no"))).alias("seg_no"),
    )
    listed = vertices.groupBy("way_id", "seg_no").agg(
        F.array_sort(F.collect_list(F.struct("pos", "node_id", "x", "y"))).alias("v")
    )
    return listed.select(
        "way_id", "seg_no", F.expr("element_at(v, -1).pos").alias("end_pos"),
        F.expr("v[0].node_id").alias("start_node"), F.expr("element_at(v, -1).node_id").alias("end_node"),
        F.expr(f"transform(v, k -> {G.point('k.x', 'k.y')})").alias("path"),
    ).where("size(array_distinct(path)) >= 2")


def require_locations(way_nodes: DataFrame, nodes: DataFrame) -> None:
    """An extract whose ways use unknown nodes is incomplete."""
    lost = way_nodes.join(nodes.where("x is not null and y is not null"), "node_id", "left_anti")
    if not lost.isEmpty():
        raise ValueError("Ways refer to nodes without location; the extract is incomplete")


def import_ways(ways: DataFrame, way_nodes: DataFrame, nodes: DataFrame, check: bool = True):
    """Route segments and barriers from tagged ways and nodes.

    ``ways``: ``way_id, tags``; ``nodes``: ``node_id, x, y, tags``.
    """
    used = ways.where("tags['highway'] is not null or tags['barrier'] is not null").select("way_id")
    refs = way_nodes.join(used, "way_id", "left_semi")
    if check:
        require_locations(refs, nodes)
    highways = ways.where("tags['highway'] is not null")
    on_highways = refs.join(highways.select("way_id"), "way_id", "left_semi")
    barrier_nodes = nodes.where("tags['barrier'] is not null")
    parts = split_ways(on_highways, nodes, barrier_nodes)
    verdict = P.pedestrian(F.col("tags"))
    routes = parts.join(highways.select("way_id", "tags", verdict.alias("verdict")), "way_id").select(
        F.concat_ws(":", F.lit("osm:way"), "way_id", "end_pos").alias("source_id"),
        "verdict.tier", "verdict.seed",
        F.concat(F.lit("osm:"), "start_node").alias("start_node"),
        F.concat(F.lit("osm:"), "end_node").alias("end_node"),
        P.grade(F.col("tags")).alias("grade"), "verdict.reason",
        P.tag(F.col("tags"), "name").alias("name"), "path",
    )
    points = barrier_nodes.select(
        F.col("node_id").cast("string").alias("node_id"), P.barrier_blocks(F.col("tags")).alias("blocking"),
        F.expr(f"array({G.point('x', 'y')})").alias("path"),
    )
    barrier_ways = ways.where("tags['barrier'] is not null")
    lines = (
        refs.join(barrier_ways, "way_id").join(nodes.select("node_id", "x", "y"), "node_id")
        .groupBy("way_id").agg(
            F.first("tags").alias("tags"),
            F.array_sort(F.collect_list(F.struct("pos", F.expr(G.point("x", "y")).alias("p")))).alias("v"),
        )
        .select(F.lit("").alias("node_id"), P.barrier_blocks(F.col("tags")).alias("blocking"), F.expr("v.p").alias("path"))
        .where("size(array_distinct(path)) >= 2")
    )
    return routes, points.unionByName(lines)


def official_lines(features: DataFrame, role: str = "prow", removed: DataFrame | None = None) -> DataFrame:
    """Official lines as routes without nodes; ``removed`` areas are cut away first.

    ``features``: ``line_id, lines (array of paths)``.
    """
    parts = explode_lines(features, ["line_id"])
    if removed is not None:
        whole = parts.withColumn("key", F.struct("line_id", "part_no"))
        cut = O.lines_outside(whole.select("key", "path"), "key", S.polygon_pieces(removed.select("rings")))
        order = Window.partitionBy("line_id").orderBy("source_part", "part_no")
        parts = cut.select(
            "key.line_id", F.col("key.part_no").alias("source_part"), "part_no", "path"
        ).withColumn("part_no", F.row_number().over(order) - 1)
    return parts.select(
        F.concat_ws(":", F.lit(role), "line_id", "part_no").alias("source_id"),
        F.lit("official").alias("tier"), F.lit(False).alias("seed"), F.lit("").alias("start_node"),
        F.lit("").alias("end_node"), F.lit("0:no:no").alias("grade"), F.lit("").alias("reason"),
        F.lit("").alias("name"), "path",
    )


def require_lines(routes: DataFrame) -> DataFrame:
    if routes.isEmpty():
        raise ValueError("No official route lines were accepted")
    return routes


def lines_beyond(lines: DataFrame, boundary: DataFrame, slack_m: float = 5.0) -> DataFrame:
    """Replacement lines that leave their authority by more than ``slack_m``: must be empty."""
    segments = S.path_segments(lines.select("source_id", "path"), ["source_id"])
    pieces = S.polygon_pieces(boundary.select("rings"))
    inside = S.covered_spans(segments, pieces.select("edges", *S.BOUNDS)).select(
        F.col("a_source_id").alias("source_id"), F.col("a_edge_no").alias("edge_no"), F.col("a_s").alias("s"), "t0", "t1"
    )
    pairs = S.near_pairs(segments, S.outline_segments(pieces, []).drop("edge_no"), slack_m).withColumn(
        "p", G.keep(G.capsule_span("a_s", "b_s", slack_m), "c", "c is not null")
    )
    band = pairs.select(
        F.col("a_source_id").alias("source_id"), F.col("a_edge_no").alias("edge_no"), F.col("a_s").alias("s"), "p.t0", "p.t1"
    )
    covered = S.union_measures(inside.unionByName(band), ["source_id", "edge_no", "s"], {"u": F.lit(True)})
    full = covered.where("u >= 1 - 1e-9").select("source_id", "edge_no")
    return segments.join(full, ["source_id", "edge_no"], "left_anti").select("source_id").distinct()


def dense_index(df: DataFrame, order: list[str], out: str = "route_index") -> DataFrame:
    """Number rows from 0 in the given order without moving them through one task.

    Rows are range partitioned and numbered per partition; only one row count per partition is
    combined to offsets.
    """
    from strollgraph.session import cut

    ranged = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"), F.min(F.struct(*order)).alias("_low"))
    offsets = sizes.select(
        "_part",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_low").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_offset"),
    )
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return (
        ranged.withColumn("_local", local).join(offsets, "_part")
        .withColumn(out, (F.col("_local") + F.col("_offset")).cast("bigint"))
        .drop("_local", "_offset", "_part")
    )


# --- hints and display context -------------------------------------------------------------------


def unverified_commons(areas: DataFrame) -> DataFrame:
    """Areas tagged as common, first row per source: clues without any statutory right.

    ``areas``: ``source_id, tags, rings``.
    """
    commons = areas.where(P.is_common(F.col("tags"))).where(F.expr(f"{G.polygon_area('rings')} > 0"))
    first = commons.groupBy("source_id").agg(
        F.min_by(F.struct("tags", "rings"), F.to_json("tags")).alias("f")
    )
    tags = F.col("f.tags")
    return first.select(
        "source_id", F.concat(F.lit("hint:"), "source_id").alias("site_id"), P.tag(tags, "name").alias("name"),
        P.tag(tags, "access").alias("access"), P.tag(tags, "foot").alias("foot"),
        T.attributes_json(tags).alias("source_attributes"), F.lit("unverified_osm_common").alias("verification"),
        F.col("f.rings").alias("rings"),
    )


def context_features(areas: DataFrame, lines: DataFrame, places: DataFrame) -> DataFrame:
    """Display features by layer and kind: ``layer, feature_id, kind, name``; inputs carry ``feature_id, tags``."""
    tags = F.col("tags")
    name = P.tag(tags, "name")

    def layer(df: DataFrame, label: str, kind: Column) -> DataFrame:
        rows = df.select(F.lit(label).alias("layer"), "feature_id", kind.alias("kind"), name.alias("name"))
        return rows.where("kind is not null")

    named = places.where(P.tag(tags, "place").isin(P.PLACE_KINDS) & (name != ""))
    return (
        layer(areas, "areas", P.area_kind(tags))
        .unionByName(layer(lines, "lines", P.line_kind(tags)))
        .unionByName(layer(named, "places", P.tag(tags, "place")))
    )


def kind_counts(features: DataFrame) -> DataFrame:
    return features.groupBy("layer", "kind").agg(F.count("*").alias("features"))
