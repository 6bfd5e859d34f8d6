"""Writing result layers, tables and map exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strollgraph.functions import projection as R
from strollgraph.functions import text as T

PARTITION_M = 50000.0


#: Columns that put the rows of a result in order, the first that it has.
ORDER = ("site_id", "component_id", "previous_site_id", "route", "route_index", "source_id", "code", "name")


def in_order(frame: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Rows in the order of the given columns (or those of ``ORDER``): ranges are dealt to tasks and sorted there, so files read by name are in order."""
    keys = [c for c in (ORDER if order is None else order) if c in frame.columns]
    return frame.orderBy(*keys) if keys else frame


def write_layers(layers: dict[str, DataFrame], out: str) -> None:
    """One Parquet folder per layer, in order; an empty layer keeps its schema."""
    for name, frame in layers.items():
        in_order(frame).write.mode("overwrite").parquet(f"{out}/{name}")


def write_table(frame: DataFrame, path: str, order: list[str] | None = None) -> None:
    """A CSV folder with header, in order."""
    flat_columns(in_order(frame, order)).write.mode("overwrite").option("header", True).csv(path)


def flat_columns(frame: DataFrame) -> DataFrame:
    """Columns a CSV can hold; nested ones become JSON text.

    Spark prints doubles with all digits needed to read them back.
    """
    nested = ("array", "map", "struct")
    return frame.select(*[
        F.to_json(f"`{f.name}`").alias(f.name) if f.dataType.typeName() in nested else F.col(f"`{f.name}`")
        for f in frame.schema.fields
    ])


def write_site_tables(sites: DataFrame, out: str) -> None:
    """Full, candidate and permissive tables as CSV with header."""
    chosen = {
        "sites": sites,
        "likely_access_islands": sites.where("status = 'likely_access_island'"),
        "permissive_access_evidenced": sites.where("status = 'permissive_access_evidenced'"),
    }
    for name, frame in chosen.items():
        write_table(frame, f"{out}/{name}")


def lonlat_rings(polygons: str = "polygons") -> Column:
    """GeoJSON MultiPolygon coordinates of grid polygons."""
    at = "v -> " + f"transform(array({R.grid_to_lonlat('v.x', 'v.y')}), g -> array(g.x, g.y))[0]"
    return F.expr(f"transform({polygons}, pg -> transform(pg, rg -> transform(rg, {at})))")


def site_polygons(membership: DataFrame, land: DataFrame) -> DataFrame:
    """Component polygons of a site for export, one row each: ``site_id, component_id, polygons``."""
    return membership.join(land.select("component_id", "rings"), "component_id").select(
        "site_id", "component_id", F.array("rings").alias("polygons")
    )


def geojson_features(frame: DataFrame, properties: list[str]) -> DataFrame:
    """One GeoJSON feature per row as text: ``value``; ``frame`` has ``polygons``."""
    body = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*properties).alias("properties"),
        F.struct(F.lit("MultiPolygon").alias("type"), lonlat_rings().alias("coordinates")).alias("geometry"),
    )
    return frame.select(F.to_json(body).alias("value"))


def write_candidates_geojson(sites: DataFrame, polygons: DataFrame, out: str) -> None:
    """Candidates in longitude and latitude, one feature per component and line; ``component_id`` tells them apart."""
    rows = sites.where("status = 'likely_access_island'").join(polygons, "site_id")
    geojson_features(in_order(rows, ["site_id", "component_id"]), [*sites.columns, "component_id"]).write.mode("overwrite").text(f"{out}/likely_access_islands.geojson")


def partition_key(easting: str = "easting", northing: str = "northing", size: float = PARTITION_M) -> Column:
    """50 km cell of a point as ``x_y``."""
    return F.expr(
        f"concat_ws('_', cast(floor({easting} / {size}D) as bigint), cast(floor({northing} / {size}D) as bigint))"
    )


def write_partitioned_polygons(sites: DataFrame, polygons: DataFrame, out: str) -> None:
    """Site polygons in folders of one 50 km cell each."""
    rows = sites.select("site_id", partition_key().alias("partition")).join(polygons, "site_id")
    rows.repartition("partition", F.pmod(F.xxhash64("site_id"), F.lit(16))).write.mode("overwrite").partitionBy(
        "partition"
    ).parquet(f"{out}/polygons")


def site_markers(sites: DataFrame, bounds: DataFrame) -> DataFrame:
    """Compact row per site for a map: ``bounds`` has ``site_id`` and the box of the site."""

    def listed(one: str, many: str) -> Column:
        names = F.concat(F.array(F.col(one)), F.split(F.col(many), ";"))
        return F.array_join(F.array_sort(F.array_distinct(F.filter(names, lambda n: n != ""))), ";")

    return sites.join(bounds, "site_id").select(
        "site_id", "name", "status", "county", "council",
        listed("county", "all_counties").alias("counties"), listed("council", "all_councils").alias("councils"),
        "xmin", "ymin", "xmax", "ymax", F.round("area_ha", 3).alias("area"), "reasons",
        F.col("evidence_strength").alias("evidence"), partition_key().alias("partition"),
    )


def search_sites(
    sites: DataFrame,
    statuses: list[str] | None = None,
    county: str | None = None,
    council: str | None = None,
    text: str | None = None,
) -> DataFrame:
    """Sites by status set, county, council and a case-insensitive text in name or id."""
    if statuses:
        sites = sites.where(F.col("status").isin(statuses))
    if county:
        sites = sites.where((F.col("county") == county) | T.in_list(F.col("all_counties"), county))
    if council:
        sites = sites.where((F.col("council") == council) | T.in_list(F.col("all_councils"), council))
    if text:
        sites = sites.where(F.lower(F.concat_ws(" ", "name", "site_id")).contains(text.lower()))
    return sites
