"""Access and display rules over OpenStreetMap tags as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tag vocabularies and tier names shared with the published screening rules.
PUBLIC_DESIGNATIONS = ["public_footpath", "public_bridleway", "restricted_byway", "byway_open_to_all_traffic"]
ROAD_HIGHWAYS = [
    "primary", "secondary", "tertiary", "unclassified", "residential", "living_street",
    "primary_link", "secondary_link", "tertiary_link", "pedestrian",
]
PROHIBITED_HIGHWAYS = ["motorway", "motorway_link", "construction", "proposed"]
BLOCKED_VALUES = ["no", "private", "customers", "delivery", "agricultural", "forestry", "use_sidepath"]
ALLOWED_VALUES = ["yes", "designated", "official"]
PASSABLE_BARRIERS = ["gate", "kissing_gate", "stile", "entrance", "bollard", "cycle_barrier"]
SAFE_TIERS = ["official", "public", "inferred"]
PERMITTED_TIERS = SAFE_TIERS + ["permissive"]
POSSIBLE_TIERS = PERMITTED_TIERS + ["unknown"]
COMMON_KEYS = ["designation", "leisure", "landuse"]
TRUE_WORDS = ["yes", "true", "1"]
PLACE_KINDS = ["city", "town", "village"]


def tag(tags: Column, key: str) -> Column:
    """Tag value with absent read as empty."""
    return F.coalesce(tags[key], F.lit(""))


def effective_access(tags: Column) -> Column:
    """The foot tag, or the access tag where foot is empty."""
    return F.coalesce(F.nullif(tags["foot"], F.lit("")), tag(tags, "access"))


def pedestrian(tags: Column, official: Column | None = None) -> Column:
    """``struct<tier,seed,reason>`` for a tagged way; the first matching rule wins."""
    highway, foot, designation = tag(tags, "highway"), tag(tags, "foot"), tag(tags, "designation")
    effective = effective_access(tags)
    public, road = designation.isin(PUBLIC_DESIGNATIONS), highway.isin(ROAD_HIGHWAYS)
    conditional = (tag(tags, "foot:conditional") != "") | (tag(tags, "access:conditional") != "")

    def verdict(tier: str, seed: Column | bool, reason: str) -> Column:
        seed = seed if isinstance(seed, Column) else F.lit(seed)
        return F.struct(F.lit(tier).alias("tier"), seed.alias("seed"), F.lit(reason).alias("reason"))

    return (
        F.when(F.lit(False) if official is None else F.coalesce(official, F.lit(False)), verdict("official", False, ""))
        .when(highway.isin(PROHIBITED_HIGHWAYS), verdict("excluded", False, "pedestrian_prohibited"))
        .when(public & foot.isin(BLOCKED_VALUES), verdict("unknown", False, "conflicting_access_tags"))
        .when(effective.isin(BLOCKED_VALUES), verdict("excluded", False, "pedestrian_prohibited"))
        .when(conditional, verdict("unknown", road, "conditional_access"))
        .when(effective == "permissive", verdict("permissive", False, "permissive_only"))
        .when(effective.isin(ALLOWED_VALUES) | public, verdict("public", road, ""))
        .when(road & (effective == ""), verdict("inferred", True, "road_access_inferred"))
        .otherwise(verdict("unknown", False, "access_not_recorded"))
    )


def barrier_blocks(tags: Column) -> Column:
    effective, barrier = effective_access(tags), tag(tags, "barrier")
    return (
        F.when(effective.isin(BLOCKED_VALUES), True)
        .when(barrier.isin(PASSABLE_BARRIERS), False)
        .otherwise((barrier != "") & ~effective.isin(ALLOWED_VALUES))
    )


def grade(tags: Column) -> Column:
    """Vertical position key ``layer:bridge:tunnel``."""
    return F.concat_ws(
        ":",
        F.coalesce(tags["layer"], F.lit("0")),
        F.coalesce(tags["bridge"], F.lit("no")),
        F.coalesce(tags["tunnel"], F.lit("no")),
    )


def is_common(tags: Column) -> Column:
    return F.exists(F.array(*[tag(tags, k) for k in COMMON_KEYS]), lambda v: v == "common")


def area_kind(tags: Column) -> Column:
    # The display kinds and their tags.
    natural, landuse = tag(tags, "natural"), tag(tags, "landuse")
    return (
        F.when((natural == "water") | landuse.isin("reservoir", "basin"), "water")
        .when((natural == "wood") | (landuse == "forest"), "woodland")
        .when(natural.isin("heath", "scrub", "grassland"), "open_land")
        .when(landuse.isin("residential", "industrial", "commercial", "retail"), "settlement")
    )


def line_kind(tags: Column) -> Column:
    # The display kinds and their tags.
    highway, waterway = tag(tags, "highway"), tag(tags, "waterway")
    return (
        F.when(highway.isin("motorway", "trunk", "primary", "secondary") | highway.endswith("_link"), "major_road")
        .when(highway.isin("tertiary", "unclassified", "residential", "living_street", "service"), "minor_road")
        .when(highway.isin("path", "footway", "bridleway", "track", "steps", "cycleway"), "path")
        .when(waterway == "stream", "stream")
        .when(waterway.isin("river", "canal"), "river")
        .when(tag(tags, "railway") == "rail", "railway")
    )


def legal_regimes(source_id: Column, attributes: Column) -> Column:
    """``struct<regimes array<string>, registered_common boolean>`` from a source attribute map."""
    lower = F.transform_keys(F.map_filter(attributes, lambda k, v: k.isNotNull()), lambda k, _: F.lower(k))

    def value(attrs: Column, key: str) -> Column:
        return F.trim(F.coalesce(attrs[key], F.lit("")))

    def yes(attrs: Column, key: str) -> Column:
        return F.lower(value(attrs, key)).isin(TRUE_WORDS)

    def build(attrs: Column) -> Column:
        common = yes(attrs, "rcl") | (F.upper(value(attrs, "rcl_oc")) == "RCL")
        found = F.array_compact(
            F.array(
                F.when(common, "registered_common_land"),
                F.when(yes(attrs, "oc"), "open_country"),
                F.when(source_id.startswith("dedicated:") | yes(attrs, "s16"), "section16_dedication"),
                F.when(source_id.startswith("section15:"), "section15_statutory_access"),
            )
        )
        default = F.array(F.lit("crow_access_land"))
        return F.struct(
            F.when(F.size(found) > 0, found).otherwise(default).alias("regimes"),
            common.alias("registered_common"),
        )

    return F.element_at(F.transform(F.array(lower), build), 1)
