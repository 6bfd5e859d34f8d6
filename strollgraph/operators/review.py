"""Review samples, carry-over of outcomes, desk reviews and report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

REVIEW_FIELDS = ["review_outcome", "review_notes", "review_source", "review_date"]
# Statuses in report order and the labels of the cross-table.
STATUSES = ["likely_access_island", "access_evidenced", "permissive_access_evidenced", "uncertain"]
SETTLED = ["access_evidenced", "permissive_access_evidenced"]
SAMPLE_SIZE = 10
LIST_SIZE = 25


def top_per_status(sites: DataFrame, size: int = SAMPLE_SIZE) -> DataFrame:
    """Largest sites of every status; ties by id.

    A first cut inside hashed shares of a status keeps a dominant status out of a single task.
    """
    share = F.pmod(F.xxhash64("site_id"), F.lit(64))
    order = [F.col("area_ha").desc(), F.col("site_id")]
    first = sites.withColumn("_share", share).withColumn(
        "_n", F.row_number().over(Window.partitionBy("status", "_share").orderBy(*order))
    ).where(F.col("_n") <= size)
    ranked = first.withColumn("_n", F.row_number().over(Window.partitionBy("status").orderBy(*order)))
    return ranked.where(F.col("_n") <= size).drop("_n", "_share")


def keep_first(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """First row per key in a stated order, as a partial aggregate."""
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def carry_reviews(sites: DataFrame, previous: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Review sample with earlier outcomes for unchanged shapes, and the outcomes that no longer apply.

    ``previous``: ``site_id, geometry_sha256`` and the review fields.
    """
    once = keep_first(previous, ["site_id"], [*REVIEW_FIELDS, "geometry_sha256"])
    current = sites.select("site_id", "geometry_sha256")
    valid = once.join(current, ["site_id", "geometry_sha256"], "left_semi").drop("geometry_sha256")
    lost = once.join(current, ["site_id", "geometry_sha256"], "left_anti")
    filled = lambda c: F.coalesce(F.col(c), F.lit(""))
    reviewed = valid.where((filled("review_outcome") != "") | (filled("review_notes") != "")).select("site_id")
    chosen = top_per_status(sites).unionByName(sites.join(reviewed, "site_id", "left_semi")).dropDuplicates(["site_id"])
    sample = chosen.join(valid, "site_id", "left").withColumns({c: filled(c) for c in REVIEW_FIELDS})
    link = F.concat(F.lit("map/index.html?site="), "site_id")
    return sample.withColumn("map_link", link), lost


def append_history(history: DataFrame | None, lost: DataFrame) -> DataFrame:
    """Outcomes set aside so far plus the new ones, each once."""
    return lost.distinct() if history is None else history.unionByName(lost, allowMissingColumns=True).distinct()


def desk_reviews(ledger: DataFrame, sites: DataFrame) -> DataFrame:
    """Ledger rows whose shape is still the current one."""
    return ledger.join(sites.select("site_id", "geometry_sha256"), ["site_id", "geometry_sha256"], "left_semi")


def reviewed_sites(desk: DataFrame, sample: DataFrame) -> DataFrame:
    return desk.select("site_id").unionByName(sample.where("review_outcome <> ''").select("site_id")).distinct()


def candidate_list(sites: DataFrame, size: int = LIST_SIZE) -> DataFrame:
    """Largest candidates, numbered; the limit is taken before numbering, so one task sees few rows."""
    order = [F.col("area_ha").desc(), F.col("site_id")]
    top = sites.where(F.col("status") == "likely_access_island").orderBy(*order).limit(size)
    return top.withColumn("map_number", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def status_counts(sites: DataFrame) -> DataFrame:
    return sites.groupBy("status").agg(F.count("*").alias("sites"))


def core_table(sites: DataFrame) -> DataFrame:
    """Status by named area and surroundings with a total row; ``sites`` carries ``in_core``."""
    return sites.rollup("status").agg(
        F.count_if("in_core").alias("core"), F.count_if(~F.col("in_core")).alias("surrounding")
    ).select(F.coalesce("status", F.lit("total")).alias("status"), "core", "surrounding")


def run_summary(sites: DataFrame, min_area_m2: float) -> DataFrame:
    """One row of run figures."""
    unresolved = F.col("reasons").contains("regional_context_incomplete") & ~F.col("status").isin(SETTLED)
    return sites.agg(
        F.count("*").alias("sites"),
        F.round(F.coalesce(F.sum("area_ha"), F.lit(0.0)), 4).alias("area_ha"),
        F.count_if("registered_common_land").alias("registered_common_sites"),
        F.count_if(F.col("access_regimes").contains("section15_statutory_access")).alias("section15_sites"),
        F.count_if(F.col("area_ha") * 10000 < min_area_m2).alias("very_small_sites"),
        F.count_if(unresolved).alias("edge_unresolved_sites"),
    )


def area_index(runs: DataFrame) -> DataFrame:
    """Latest run per area: ``slug, name, completed`` and figures; earlier runs of an area drop out."""
    rest = [c for c in runs.columns if c != "slug"]
    latest = runs.groupBy("slug").agg(F.max_by(F.struct(*rest), F.struct("completed", *rest)).alias("r"))
    return latest.select("slug", "r.*")
