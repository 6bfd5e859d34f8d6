"""One call that writes everything a finished run publishes, and the checks of what was written.

The parts are plain Spark tables and text files in one folder; nothing is drawn.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strollgraph.operators import review as W
from strollgraph.operators.lineage import repeated_ids
from strollgraph.plans import validate as V
from strollgraph.session import cut
from strollgraph.sources import readers, writers

CANDIDATE, PERMISSIVE = "likely_access_island", "permissive_access_evidenced"


def report_tables(sites: DataFrame, desk: DataFrame | None = None, sample: DataFrame | None = None, sources: DataFrame | None = None) -> dict[str, DataFrame]:
    """The named tables of a report: counts, cross-table, candidates, reviews and sources.

    The cross-table needs ``in_core``; reviews need the desk ledger and the sample; both are left out otherwise.
    """
    tables = {"status_counts": W.status_counts(sites), "candidates": W.candidate_list(sites)}
    if "in_core" in sites.columns:
        tables["core"] = W.core_table(sites)
    if desk is not None and sample is not None:
        tables["reviewed"] = sites.join(W.reviewed_sites(desk, sample), "site_id", "left_semi")
    if sources is not None:
        tables["sources"] = sources
    return tables


def export_run(
    sites: DataFrame,
    membership: DataFrame,
    components: DataFrame,
    out: str,
    previous_review: DataFrame | None = None,
    history: DataFrame | None = None,
    manifest: dict | None = None,
    ledger: DataFrame | None = None,
    sources: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Write site tables, review sample and history, candidate shapes, polygon partitions, markers, reports and a manifest below ``out``.

    Outcomes of ``previous_review`` are carried over where the shape is unchanged; the others move to the history.  Rows of the desk ``ledger``
    count as reviews while their shape is the current one.  Everything read is taken before anything is written, so the earlier files of ``out`` may
    be among the inputs.
    """
    spark = sites.sparkSession
    fixed = lambda df: None if df is None else cut(df)
    previous_review, history, ledger = fixed(previous_review), fixed(history), fixed(ledger)
    writers.write_site_tables(sites, out)
    writers.write_table(membership, f"{out}/site_membership", ["site_id", "component_id"])
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in ["site_id", "geometry_sha256", *W.REVIEW_FIELDS]))
    sample, lost = W.carry_reviews(sites, previous_review if previous_review is not None else empty)
    sample = cut(sample)
    writers.write_table(sample, f"{out}/review_sample")
    kept = cut(W.append_history(history, lost))
    writers.write_table(kept, f"{out}/review_history", ["site_id", "geometry_sha256"])
    polygons = cut(writers.site_polygons(membership, components))
    writers.write_candidates_geojson(sites, polygons, out)
    writers.write_partitioned_polygons(sites, polygons, out)
    corners = polygons.select("site_id", F.expr("explode(flatten(flatten(polygons)))").alias("p"))
    bounds = corners.groupBy("site_id").agg(
        F.min("p.x").alias("xmin"), F.min("p.y").alias("ymin"), F.max("p.x").alias("xmax"), F.max("p.y").alias("ymax")
    )
    if {"county", "council"} <= set(sites.columns):
        writers.site_markers(sites, bounds).write.mode("overwrite").json(f"{out}/markers")
    desk = sample.select("site_id").limit(0) if ledger is None else W.desk_reviews(ledger, sites)
    for name, table in report_tables(sites, desk, sample, sources).items():
        writers.flat_columns(table).write.mode("overwrite").option("header", True).csv(f"{out}/report/{name}")
    known = json.dumps({**(manifest or {}), "nearest_route_search_limit_m": 6400}, sort_keys=True)
    spark.range(1).select(F.lit(known).alias("value")).write.mode("overwrite").text(f"{out}/run_manifest")
    return {"review_sample": sample, "review_history": kept}


def check_export(spark: SparkSession, out: str, sites: DataFrame, shapes: DataFrame, selected: DataFrame | None = None) -> DataFrame:
    """``check, violations`` of the written files against the run: ids of every file, uniqueness, inventory and shapes."""
    table = lambda name: spark.read.csv(f"{out}/{name}", header=True)
    features = readers.read_features(spark, f"{out}/likely_access_islands.geojson", "geojson", readers.LONLAT_CRS, required=False)
    drawn = features.select(F.col("attributes")["site_id"].alias("site_id"))
    of = lambda status: sites.where(F.col("status") == status)
    checks = {
        "table_ids": V.id_mismatch(table("sites"), sites, "site_id"),
        "repeated_ids": repeated_ids(table("sites")),
        "membership_ids": V.id_mismatch(table("site_membership"), sites, "site_id"),
        "candidate_table_ids": V.id_mismatch(table("likely_access_islands"), of(CANDIDATE), "site_id"),
        "candidate_shape_ids": V.id_mismatch(drawn, of(CANDIDATE), "site_id"),
        "permissive_ids": V.id_mismatch(table("permissive_access_evidenced"), of(PERMISSIVE), "site_id"),
        "empty_shapes": sites.join(shapes.where("whole.area > 0").select(F.col("node").alias("site_id")), "site_id", "left_anti"),
        "points_outside": V.points_outside(sites.select("site_id", "easting", "northing"), shapes),
    }
    if selected is not None:
        checks["selected_inventory"] = V.id_mismatch(sites, selected, "site_id")
    return V.check_table(checks)
