"""Checks of a finished run as one table of violation counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strollgraph.operators import overlay as O
from strollgraph.operators.lineage import repeated_ids


def id_mismatch(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Ids found on one side only: ``key, side``."""
    a = left.select(key).distinct().withColumn("in_left", F.lit(True))
    b = right.select(key).distinct().withColumn("in_right", F.lit(True))
    both = a.join(b, key, "full_outer").where("in_left is null or in_right is null")
    return both.select(key, F.when(F.col("in_left"), "left").otherwise("right").alias("side"))


def points_outside(points: DataFrame, shapes: DataFrame) -> DataFrame:
    """Sites whose representative point is not covered by their own land."""
    placed = points.select("site_id", F.expr("array(named_struct('x', easting, 'y', northing))").alias("path"))
    areas = shapes.withColumnRenamed("node", "area_id")
    inside = O.points_in_areas(placed, "site_id", areas, "area_id", F.col("a_site_id") == F.col("b_area_id"))
    return points.select("site_id").join(inside, "site_id", "left_anti")


def check_table(violations: dict[str, DataFrame]) -> DataFrame:
    """One row per check with its number of violations."""
    rows = [df.agg(F.count("*").alias("violations")).withColumn("check", F.lit(name)) for name, df in violations.items()]
    return reduce(DataFrame.unionByName, rows).select("check", "violations")


def validate_run(sites: DataFrame, membership: DataFrame, catalogue_sites: DataFrame, shapes: DataFrame) -> DataFrame:
    """The standing checks: ids agree across tables, are unique, and points lie on their land."""
    return check_table(
        {
            "membership_ids": id_mismatch(sites, membership, "site_id"),
            "catalogue_ids": id_mismatch(sites, catalogue_sites, "site_id"),
            "repeated_ids": repeated_ids(sites),
            "points_outside": points_outside(sites.select("site_id", "easting", "northing"), shapes),
        }
    )


def require_clean(checks: DataFrame) -> None:
    bad = checks.where("violations > 0").take(1)
    if bad:
        raise ValueError(f"Run check {bad[0]['check']} found {bad[0]['violations']} violations")
