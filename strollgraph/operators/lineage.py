"""Growing a site catalogue, keeping ids stable and describing legal regimes."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strollgraph.functions import policy as P
from strollgraph.functions import text as T
from strollgraph.operators import sites as D
from strollgraph.operators import spatial as S
from strollgraph.operators.components import connected_components
from strollgraph.session import cut

SAME_AREA_M2 = 1e-6


def extend_sites(
    old: D.Catalogue, new_land: DataFrame
) -> tuple[D.Catalogue, DataFrame]:
    """Catalogue with new components added, and ``site_id, previous_site_id`` of the old sites inside.

    Only pairs that involve a new component are tested; the old pieces and their stretches are read where the catalogue keeps them.
    Outlines are rebuilt only for groups that took in a new component.
    """
    columns = ["component_id", "source_id", "name", "source_attributes", "rings"]
    land = old.components.select(*columns).unionByName(new_land.select(*columns))
    known = old.pieces
    if known is None:
        known = cut(S.polygon_pieces(old.components.select("component_id", "rings")))
    copies = cut(D.collapse_copies(new_land))
    unique = new_land.join(copies.where("component_id = rep").select("component_id"), "component_id", "left_semi")
    fresh_pieces = cut(S.polygon_pieces(unique.select("component_id", "rings")))
    both = known.unionByName(fresh_pieces)
    # New outlines against everything, and old outlines against new shapes for new parts inside old land.
    spans = cut(D.touching_spans(fresh_pieces, both).unionByName(D.touching_spans(known, fresh_pieces)))
    node = cut(
        old.membership.select("component_id", _old_node().alias("node")).unionByName(
            copies.select("component_id", F.concat(F.lit("new:"), "rep").alias("node"))
        )
    )
    pairs = (
        D.touching_pairs(spans)
        .join(node.withColumnsRenamed({"component_id": "a", "node": "na"}), "a")
        .join(node.withColumnsRenamed({"component_id": "b", "node": "nb"}), "b")
    )
    roots = connected_components(pairs, "na", "nb")
    # An old site without a pair stays as it is, with its id, row and outline; the others and the new components form new sites.
    joined = cut(old.sites.select(F.col("site_id").alias("previous_site_id"), _old_node().alias("node")).join(roots, "node").drop("node"))
    moved = joined.select(F.col("previous_site_id").alias("site_id"), "root")
    same = lambda df: df.join(moved.select("site_id"), "site_id", "left_anti")
    grouped = old.membership.join(moved, "site_id").select("component_id", "root").unionByName(
        node.where(F.col("node").startswith("new:")).join(roots, "node", "left").select("component_id", F.coalesce("root", "node").alias("root"))
    )
    members = cut(land.select("component_id", "source_id", "name").join(grouped, "component_id"))
    rolled = cut(D.site_rollup(members, "root"))
    ids = rolled.select("root", "site_id")
    changed = cut(members.join(ids, "root").select("site_id", "component_id"))
    membership = cut(same(old.membership).select("site_id", "component_id").unionByName(changed))
    previous = same(old.sites).select("site_id", F.col("site_id").alias("previous_site_id")).unionByName(
        joined.join(ids, "root").select("site_id", "previous_site_id")
    )
    part = changed.select("component_id")
    known_part = known.join(part, "component_id", "left_semi")
    # Stretches that involve a new component are known from above, so only those among old ones are added.
    old_spans = D.touching_spans(known_part, known_part) if old.spans is None else old.spans.join(part, "component_id", "left_semi")
    fresh = cut(
        D.union_outline(known_part.unionByName(fresh_pieces), old_spans.unionByName(spans))
        .join(changed, "component_id")
        .select("site_id", "component_id", "edge", "s")
    )
    outline = cut(same(old.outline).select(*fresh.columns).unionByName(fresh))
    formed = (
        rolled.drop("root")
        .join(D.outline_area(fresh, "site_id"), "site_id")
        .join(D.outline_hash(fresh, "site_id"), "site_id")
        .withColumn("area_ha", F.col("area_m2") / 10000)
        .drop("area_m2")
    )
    sites = cut(same(old.sites).select(*formed.columns).unionByName(formed))
    return D.Catalogue(sites, membership, outline, land, both), cut(previous)


def _old_node() -> Column:
    return F.concat(F.lit("old:"), "site_id")


def site_overlaps(current: D.Catalogue, earlier: D.Catalogue, same: DataFrame | None = None) -> DataFrame:
    """Overlap area of current and earlier sites: ``site_id, previous_site_id, overlap_m2``.

    ``same`` may name (``site_id``) sites that both catalogues have with the same components, such as those that ``extend_sites`` leaves alone.
    Sites of one catalogue share no area, so such a site overlaps itself with its area and nothing else; only the others are measured.
    """
    whole, rest = None, lambda df: df
    if same is not None:
        whole = current.sites.join(same, "site_id", "left_semi").select(
            "site_id", F.col("site_id").alias("previous_site_id"), (F.col("area_ha") * 10000).alias("overlap_m2")
        )
        rest = lambda df: df.join(same, "site_id", "left_anti")
    shaped = lambda c: cut(D.catalogue_shapes(replace(c, membership=rest(c.membership))).select("node", "edges", *S.BOUNDS))
    now, then = shaped(current), shaped(earlier)
    # Both sides are unions of components, so both need the dissolved outline.
    forward = S.segment_bounds(rest(current.outline).select(F.col("site_id").alias("k"), "s"))
    backward = S.segment_bounds(rest(earlier.outline).select(F.col("site_id").alias("k"), "s"))

    def parts(segments: DataFrame, shapes: DataFrame, inner: bool) -> DataFrame:
        spans = S.covered_spans(segments, shapes.select(F.col("node").alias("k"), "edges", *S.BOUNDS)).select(
            "a_k", "a_s", "b_k", "is_left", "t0", "t1"
        )
        flags = {"l": F.col("is_left")}
        if inner:
            flags |= {"r": ~F.col("is_left"), "u": F.lit(True)}
        share = F.col("l") + F.col("r") - F.col("u") if inner else F.col("l")
        cross = F.expr("a_s.x0 * a_s.y1 - a_s.x1 * a_s.y0")
        return S.union_measures(spans, ["a_k", "a_s", "b_k"], flags).select("a_k", "b_k", (cross * share).alias("part"))

    first = parts(forward, then, False).select(
        F.col("a_k").alias("site_id"), F.col("b_k").alias("previous_site_id"), "part"
    )
    second = parts(backward, now, True).select(
        F.col("b_k").alias("site_id"), F.col("a_k").alias("previous_site_id"), "part"
    )
    measured = (
        first.unionByName(second)
        .groupBy("site_id", "previous_site_id")
        .agg((F.sum("part") / 2).alias("overlap_m2"))
    )
    return (measured if whole is None else whole.unionByName(measured)).where(F.col("overlap_m2") > SAME_AREA_M2)


@dataclass(frozen=True)
class Reconciled:
    sites: DataFrame
    replacements: DataFrame
    lineage: DataFrame


def reconcile_ids(current: D.Catalogue, earlier: D.Catalogue, overlaps: DataFrame) -> Reconciled:
    """Reuse an earlier id only for the same complete shape; re-key ids that now mean another shape.

    Two sites have the same shape when their overlap area equals both areas.
    """
    old = earlier.sites.select(F.col("site_id").alias("previous_site_id"), (F.col("area_ha") * 10000).alias("old_m2"))
    now = current.sites.select("site_id", (F.col("area_ha") * 10000).alias("new_m2"), "geometry_sha256")
    compared = (
        overlaps.join(old, "previous_site_id")
        .join(now, "site_id")
        .withColumn(
            "same",
            (F.abs(F.col("overlap_m2") - F.col("old_m2")) <= 1e-4) & (F.abs(F.col("overlap_m2") - F.col("new_m2")) <= 1e-4),
        )
    )
    equal = compared.where("same").groupBy("site_id").agg(
        F.count("*").alias("n"), F.min("previous_site_id").alias("keep_id")
    ).where("n = 1")
    fresh_id = T.site_id(F.array("site_id", "geometry_sha256"))
    decided = (
        now.join(equal.select("site_id", "keep_id"), "site_id", "left")
        .join(old.select(F.col("previous_site_id").alias("site_id"), F.lit(True).alias("taken")), "site_id", "left")
        .select(
            "site_id",
            F.when(F.col("keep_id").isNotNull(), F.col("keep_id"))
            .when(F.col("taken"), fresh_id)
            .otherwise(F.col("site_id"))
            .alias("new_id"),
        )
    )
    decided = cut(decided)
    lineage = compared.join(decided, "site_id").select(
        "previous_site_id",
        F.col("new_id").alias("site_id"),
        F.when(F.col("same"), "unchanged_geometry").otherwise("changed_geometry").alias("relationship"),
        "overlap_m2",
    )
    sites = current.sites.join(decided, "site_id").withColumn("site_id", F.col("new_id")).drop("new_id")
    return Reconciled(sites, decided.where("site_id <> new_id"), lineage)


def repeated_ids(sites: DataFrame) -> DataFrame:
    """Site ids used more than once: must be empty."""
    return sites.groupBy("site_id").agg(F.count("*").alias("n")).where("n > 1").select("site_id")


def replace_ids(rows: DataFrame, replacements: DataFrame) -> DataFrame:
    """Rewrite ``site_id`` through a replacement table; other ids stay."""
    return (
        rows.join(replacements, "site_id", "left")
        .withColumn("site_id", F.coalesce("new_id", "site_id"))
        .drop("new_id")
    )


def legal_metadata(land: DataFrame) -> DataFrame:
    """Regimes and common flag per component from its source attributes."""
    found = P.legal_regimes(F.col("source_id"), T.attributes_map(F.col("source_attributes")))
    return land.withColumn("_legal", found).select(
        *land.columns,
        F.array_join("_legal.regimes", ";").alias("access_regimes"),
        F.col("_legal.registered_common").alias("registered_common_land"),
    )


def annotate_sites(sites: DataFrame, land: DataFrame, membership: DataFrame) -> DataFrame:
    """Regimes, common flag and source attributes of all components of a site."""
    rows = legal_metadata(
        land.select("component_id", "source_id", "source_attributes")
    ).join(membership, "component_id")
    # One attribute text per source, the last component's as in a keyed update.
    by_source = rows.groupBy("site_id", "source_id").agg(
        F.max_by("source_attributes", "component_id").alias("attrs"),
        F.collect_set("access_regimes").alias("regimes"),
        F.bool_or("registered_common_land").alias("common"),
    )
    body = F.transform(
        F.array_sort(F.collect_list(F.struct("source_id", "attrs"))),
        lambda e: F.concat(F.lit('"'), e["source_id"], F.lit('": '), e["attrs"]),
    )
    grouped = by_source.groupBy("site_id").agg(
        T.joined_list(F.flatten(F.transform(F.flatten(F.collect_list("regimes")), lambda r: F.split(r, ";")))).alias(
            "access_regimes"
        ),
        F.bool_or("common").alias("registered_common_land"),
        F.concat(F.lit("{"), F.array_join(body, ", "), F.lit("}")).alias("legal_source_attributes"),
    )
    earlier = ["access_regimes", "registered_common_land", "legal_source_attributes"]
    return sites.drop(*earlier).join(grouped, "site_id", "left")


@dataclass(frozen=True)
class Combined:
    sites: DataFrame
    membership: DataFrame
    components: DataFrame
    lineage: DataFrame


def combined_catalogue(grown: D.Catalogue, earlier: D.Catalogue, overlaps: DataFrame | None = None) -> Combined:
    """A grown catalogue under the ids of the earlier one, with the regimes of all its components.

    ``overlaps`` may be given if it is known.  An id that two sites would share is an error.
    """
    overlaps = cut(site_overlaps(grown, earlier)) if overlaps is None else overlaps
    done = reconcile_ids(grown, earlier, overlaps)
    sites = cut(done.sites)
    twice = repeated_ids(sites).take(1)
    if twice:
        raise ValueError(f"Two sites would share the id {twice[0][0]}")
    membership = cut(replace_ids(grown.membership, done.replacements))
    return Combined(annotate_sites(sites, grown.components, membership), membership, grown.components, done.lineage)
