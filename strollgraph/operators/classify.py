"""Reachability variants and the status decision."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strollgraph.functions import policy as P
from strollgraph.operators import network as N
from strollgraph.operators.components import connected_components, reachable
from strollgraph.session import cut

VERY_SMALL = "very_small_site_geometry"
EDGE_NOTE = "regional_context_incomplete"


@dataclass(frozen=True)
class Variant:
    name: str
    tolerance: float
    tiers: tuple[str, ...]
    weak: bool = False


def variants(tolerance: float) -> list[Variant]:
    """Three tolerances with public tiers, the same with permissive tiers, and everything possible."""
    relaxed = max(5.0, tolerance)
    steps = [("exact", 0.0), ("default", float(tolerance)), ("relaxed", relaxed)]
    safe, permitted = tuple(P.SAFE_TIERS), tuple(P.PERMITTED_TIERS)
    return (
        [Variant(f"{n}_access", t, safe) for n, t in steps]
        + [Variant(f"{n}_permissive_access", t, permitted) for n, t in steps]
        + [Variant("possible_access", relaxed, tuple(P.POSSIBLE_TIERS), weak=True)]
    )


def admitted(kind: Column, variant: Variant) -> Column:
    """May a node of this kind (route tier, ``site`` or ``hint``) be used in the variant."""
    return kind.isin(list(variant.tiers) + ["site"] + (["hint"] if variant.weak else []))


def listed_edges(edges: DataFrame, kinds: DataFrame, chosen: list[Variant]) -> DataFrame:
    """Pairs of nodes with the variants that admit an edge between them, one bit each: ``a, b, bits``; ``kinds`` has ``node, kind``."""
    typed = edges.join(kinds.withColumnsRenamed({"node": "a", "kind": "kind_a"}), "a").join(
        kinds.withColumnsRenamed({"node": "b", "kind": "kind_b"}), "b"
    )
    bits = F.lit(0)
    for i, v in enumerate(chosen):
        test = (
            admitted(F.col("kind_a"), v) & admitted(F.col("kind_b"), v)
            & (F.col("distance") <= v.tolerance)
            & (F.lit(v.weak) | ~F.col("weak"))
        )
        bits = bits.bitwiseOR(F.when(test, 1 << i).otherwise(0))
    return typed.groupBy("a", "b").agg(F.bit_or(bits).alias("bits")).where("bits <> 0")


def named(chosen: list[Variant]) -> Column:
    """One row per variant of ``bits``."""
    return F.explode(F.array_compact(F.array(*[F.when(F.col("bits").bitwiseAND(1 << i) != 0, v.name) for i, v in enumerate(chosen)])))


def variant_edges(edges: DataFrame, kinds: DataFrame, chosen: list[Variant]) -> DataFrame:
    """Edges admitted per variant: ``variant, a, b``."""
    return listed_edges(edges, kinds, chosen).select(named(chosen).alias("variant"), "a", "b")


def variant_seeds(seeds: DataFrame, kinds: DataFrame, chosen: list[Variant]) -> DataFrame:
    nodes = seeds.select(N.route_node("route_index").alias("node")).join(kinds, "node")
    tests = [F.when(admitted(F.col("kind"), v), v.name) for v in chosen]
    return nodes.select(F.explode(F.array_compact(F.array(*tests))).alias("variant"), "node")


def variant_roots(edges: DataFrame, kinds: DataFrame, chosen: list[Variant], only: DataFrame | None = None) -> DataFrame:
    """Components of all variants: ``variant, node, root``, for the nodes of ``only`` (``node``) if they are given.

    The edges that all variants share are most of them, so they are contracted once; one keyed run then joins their components by the others.
    """
    listed = cut(listed_edges(edges, kinds, chosen).where("a <> b"))
    shared = F.col("bits") == (1 << len(chosen)) - 1
    base = connected_components(listed.where(shared).select("a", "b"), smallest=False)
    moved = listed.where(~shared)
    for end in ("a", "b"):
        moved = moved.join(base.withColumnsRenamed({"node": end, "root": f"_{end}"}), end, "left").withColumn(end, F.coalesce(f"_{end}", end)).drop(f"_{end}")
    above = connected_components(moved.select(named(chosen).alias("variant"), "a", "b"), keys=["variant"], smallest=False)
    tops = above.groupBy(F.col("node").alias("root")).agg(F.map_from_entries(F.collect_list(F.struct("variant", "root"))).alias("_tops"))
    if only is None:
        only = base.select("node").unionByName(above.select("node"))
    held = F.col("root").isNotNull()
    asked = only.select("node").distinct().join(base, "node", "left").select("node", F.coalesce("root", "node").alias("root"), held.alias("_held"))
    every = F.explode(F.array(*[F.lit(v.name) for v in chosen])).alias("variant")
    rows = asked.join(tops, "root", "left").select(every, "node", "root", "_held", "_tops").withColumn("_top", F.col("_tops")[F.col("variant")])
    # A node without shared edges is in a variant only where it has an edge of its own.
    return cut(rows.where("_held or _top is not null").select("variant", "node", F.coalesce("_top", "root").alias("root")))


def reach_table(sites: DataFrame, roots: DataFrame, seeds: DataFrame, chosen: list[Variant]) -> DataFrame:
    """One boolean column per variant for every site."""
    hits = reachable(roots, seeds, ["variant"])
    flags = hits.groupBy(F.col("node").alias("site_id")).agg(
        *[F.bool_or(F.col("variant") == v.name).alias(v.name) for v in chosen]
    )
    joined = sites.join(flags, "site_id", "left")
    return joined.withColumns({v.name: F.coalesce(v.name, F.lit(False)) for v in chosen})


def edge_notes(
    roots: DataFrame, boundary_nodes: DataFrame, possible: str = "possible_access", graph_nodes: DataFrame | None = None
) -> DataFrame:
    """Every node whose possible component holds a node cut by the context edge: ``node, reason``.

    A boundary site without edges is its own component and is noted too.
    """
    here = roots.where(F.col("variant") == possible).select("node", "root")
    marked = here.join(boundary_nodes, "node", "left_semi").select("root").distinct()
    reached = here.join(marked, "root", "left_semi").select("node")
    return (
        reached.unionByName(boundary_nodes.select("node")).distinct().withColumn("reason", F.lit(EDGE_NOTE))
    )


def contact_flags(contacts: DataFrame) -> DataFrame:
    """Per site: does it meet unknown, permissive or safe routes (strongest contacts)."""
    return contacts.groupBy(F.col("node").alias("site_id")).agg(
        F.bool_or(F.col("tier") == "unknown").alias("meets_unknown"),
        F.bool_or(F.col("tier") == "permissive").alias("meets_permissive"),
        F.bool_or(F.col("tier").isin(P.SAFE_TIERS)).alias("meets_safe"),
    )


def decide(
    reach: DataFrame, notes: DataFrame, contacts: DataFrame, uncovered: DataFrame, min_area_m2: float
) -> DataFrame:
    """Status, evidence strength and reasons per site.

    ``reach`` carries ``site_id``, ``area_m2`` and the variant columns; ``uncovered`` lists the sites
    that meet a coverage gap.
    """
    grouped = notes.groupBy(F.col("node").alias("site_id")).agg(F.collect_set("reason").alias("graph_notes"))
    rows = (
        reach.join(grouped, "site_id", "left")
        .join(contact_flags(contacts), "site_id", "left")
        .join(uncovered.select("site_id").distinct().withColumn("missing", F.lit(True)), "site_id", "left")
    )
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    exact, default, relaxed = F.col("exact_access"), F.col("default_access"), F.col("relaxed_access")
    permitted = (
        F.col("exact_permissive_access") & F.col("default_permissive_access") & F.col("relaxed_permissive_access")
    )
    possible, missing = F.col("possible_access"), yes("missing")
    rows = rows.withColumn(
        "notes",
        F.concat(
            F.coalesce("graph_notes", F.array().cast("array<string>")),
            F.array_compact(
                F.array(
                    F.when(F.col("area_m2") < min_area_m2, VERY_SMALL),
                    F.when(missing, "official_coverage_missing"),
                    F.when(yes("meets_unknown"), "nearby_route_access_unknown"),
                    F.when(yes("meets_permissive"), "permissive_route_nearby"),
                    F.when(exact != relaxed, "tolerance_sensitive"),
                )
            ),
        ),
    )

    def outcome(status: str, strength: str, *added: Column | str) -> Column:
        extra = F.array_compact(F.array(*[a if isinstance(a, Column) else F.lit(a) for a in added]))
        return F.struct(F.lit(status).alias("status"), F.lit(strength).alias("strength"), extra.alias("added"))

    rows = rows.withColumn(
        "outcome",
        F.when(
            default & (exact == relaxed),
            outcome("access_evidenced", "mapped_connection", "connected_to_pedestrian_road"),
        )
        .when(
            permitted,
            outcome(
                "permissive_access_evidenced", "mapped_permissive_connection",
                "connected_via_permissive_route", "permissive_access_may_be_withdrawn",
            ),
        )
        .when(
            default | possible | missing | (F.size("notes") > 0),
            outcome(
                "uncertain", "review_required",
                F.when(possible & ~default, F.lit("only_weak_or_permissive_connection")),
            ),
        )
        .otherwise(
            outcome(
                "likely_access_island", "screening_candidate", "no_evidenced_network_connection",
                F.when(yes("meets_safe"), F.lit("public_route_disconnected_from_roads")),
            )
        ),
    )
    reasons = F.array_join(F.array_sort(F.array_distinct(F.concat("notes", "outcome.added"))), ";")
    return rows.select(
        *reach.columns,
        F.col("outcome.status").alias("status"),
        F.col("outcome.strength").alias("evidence_strength"),
        reasons.alias("reasons"),
    )
