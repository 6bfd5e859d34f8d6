"""Land, routes, barriers and boundaries derived from the benchmark tables.

The tables hold no geometry, so a lattice of boxes and straight routes in whole metres is derived
from their keys and attributes.  The texts below are plain SQL and serve both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.functions import policy as P

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# One block per 4 parts, 30 orders and 3 customers; block pitch 400 m, 50 blocks per row.
LAND_SQL = """
SELECT concat('land:', p_partkey) AS component_id, p_partkey AS part_no,
  concat('land:', CAST(FLOOR(p_partkey / 2) AS BIGINT)) AS source_id,
  CASE WHEN p_size % 3 = 0 THEN '' ELSE p_name END AS name,
  concat('{"OC": "', CASE WHEN p_type = 'LARGE' THEN 'Yes' ELSE 'No' END,
         '", "rcl_oc": "', CASE WHEN p_type IN ('SMALL', 'PROMO') THEN 'rcl' ELSE '' END,
         '", "S16": "', CASE WHEN p_size % 10 = 0 THEN 'true' ELSE '' END, '"}') AS source_attributes,
  p_type = 'PROMO' AS supplemental,
  CAST(FLOOR(p_partkey / 4) AS BIGINT) AS block,
  CAST(FLOOR(p_partkey / 4) AS BIGINT) % 50 * 400 + p_partkey % 4 * 60 AS x0,
  CAST(FLOOR(p_partkey / 200) AS BIGINT) * 400 + CASE WHEN p_size % 7 = 0 THEN 40 ELSE 0 END AS y0,
  CAST(FLOOR(p_partkey / 4) AS BIGINT) % 50 * 400 + p_partkey % 4 * 60 + 30 + p_size % 3 * 30 AS x1,
  CAST(FLOOR(p_partkey / 200) AS BIGINT) * 400 + CASE WHEN p_size % 7 = 0 THEN 80 ELSE 40 END + p_size % 2 * 20 AS y1
FROM part
"""

ROUTES_SQL = """
SELECT route_index, concat('osm:way:', route_index) AS source_id, block, slot, prio, st,
  CASE WHEN slot < 6 THEN bx - 20 + slot * 50 WHEN slot < 12 THEN bx - 20 + (slot - 6) * 50
       WHEN slot < 14 THEN bx + (slot - 12) * 120 ELSE bx + 300 END AS x0,
  CASE WHEN slot < 12 THEN by0 - 20 WHEN slot < 14 THEN by0 ELSE by0 + 150 + (slot - 14) * 10 END AS y0,
  CASE WHEN slot < 6 THEN bx + 30 + slot * 50 WHEN slot < 12 THEN bx - 20 + (slot - 6) * 50
       WHEN slot < 14 THEN bx + 60 + (slot - 12) * 120 ELSE bx + 350 END AS x1,
  CASE WHEN slot < 6 THEN by0 - 20 WHEN slot < 12 THEN by0 + CASE e WHEN 0 THEN 10 WHEN 1 THEN 0 WHEN 2 THEN -1 ELSE -4 END
       WHEN slot < 14 THEN by0 ELSE by0 + 150 + (slot - 14) * 10 END AS y1,
  CASE WHEN slot < 6 THEN block * 100 + slot WHEN slot < 12 THEN block * 100 + slot - 6 ELSE block * 100 + 50 + slot END AS start_no,
  CASE WHEN slot < 6 THEN block * 100 + slot + 1 WHEN slot < 12 THEN block * 100 + 20 + slot ELSE block * 100 + 80 + slot % 10 END AS end_no,
  CASE WHEN slot < 6 THEN 'residential' ELSE 'path' END AS highway,
  CASE WHEN slot >= 6 AND prio = '1-URGENT' THEN true ELSE false END AS official,
  CASE WHEN slot < 6 AND st = 'F' THEN 'no' WHEN slot >= 6 AND prio = '2-HIGH' THEN 'yes'
       WHEN slot >= 6 AND prio = '3-MEDIUM' THEN 'permissive' ELSE '' END AS foot,
  CASE WHEN slot >= 6 AND prio = '5-LOW' THEN 'private' ELSE '' END AS access_tag,
  CASE WHEN slot >= 12 AND slot < 14 AND st = 'P' AND prio <> '1-URGENT' THEN '1:yes:no' ELSE '0:no:no' END AS grade
FROM (SELECT o_orderkey AS route_index, CAST(FLOOR(o_orderkey / 30) AS BIGINT) AS block, o_orderkey % 30 AS slot,
        o_orderpriority AS prio, o_orderstatus AS st, CAST(FLOOR(o_totalprice) AS BIGINT) % 4 AS e,
        CAST(FLOOR(o_orderkey / 30) AS BIGINT) % 50 * 400 AS bx,
        CAST(FLOOR(o_orderkey / 1500) AS BIGINT) * 400 AS by0 FROM orders) t
"""

BARRIERS_SQL = """
SELECT c_custkey AS barrier_no, CAST(FLOOR(c_custkey / 3) AS BIGINT) * 100 + 26 + c_custkey % 3 * 2 AS node_no,
  CAST(FLOOR(c_custkey / 3) AS BIGINT) % 50 * 400 - 20 + c_custkey % 3 * 100 AS x,
  CAST(FLOOR(c_custkey / 150) AS BIGINT) * 400 + CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE -10 END AS y,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'wall' WHEN 'FURNITURE' THEN 'stile' ELSE 'gate' END AS barrier,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'private' ELSE '' END AS access_tag
FROM customer
"""

# Unverified commons: one box per supplier between the road and the land of every fifth block.
HINTS_SQL = """
SELECT concat('osm:way:', s_suppkey) AS source_id, s_name AS name, s_suppkey AS hint_no,
  CASE s_nationkey % 4 WHEN 0 THEN 'private' ELSE '' END AS access,
  CASE s_nationkey % 4 WHEN 1 THEN 'yes' WHEN 2 THEN 'permissive' ELSE '' END AS foot,
  s_suppkey * 5 % 50 * 400 + s_suppkey % 4 * 60 AS x0,
  CAST(FLOOR(s_suppkey / 10) AS BIGINT) * 400 - 25 AS y0,
  s_suppkey * 5 % 50 * 400 + s_suppkey % 4 * 60 + 50 AS x1,
  CAST(FLOOR(s_suppkey / 10) AS BIGINT) * 400 - s_suppkey % 3 * 3 AS y1
FROM supplier
"""

COUNCILS_SQL = """
SELECT concat('E', n_nationkey) AS code, n_name AS name, n_nationkey * 800 + 100 AS x0, -1000 AS y0,
  n_nationkey * 800 + 900 AS x1, 50000 AS y1, n_nationkey % 6 = 0 AS is_gap, n_regionkey AS region_no
FROM nation
"""

# The strip of the last region is left out so that the council fallback is used.
COUNTIES_SQL = """
SELECT concat('C', r_regionkey) AS code, r_name AS name, r_regionkey * 4000 + 100 AS x0, -1000 AS y0,
  r_regionkey * 4000 + 4100 AS x1, 50000 AS y1
FROM region WHERE r_regionkey < 4
"""

WAY_NODES_SQL = """
SELECT l_orderkey AS way_id, l_linenumber AS pos, CAST(FLOOR(l_orderkey / 8) AS BIGINT) * 25 + MIN(l_partkey) % 25 AS node_id
FROM lineitem GROUP BY l_orderkey, l_linenumber
"""

REVIEWS_SQL = """
SELECT concat('land:', doc_id) AS component_id, CASE WHEN quality = 1 THEN 'compared' ELSE '' END AS review_outcome,
  CASE WHEN toxic = 1 THEN 'note' ELSE '' END AS review_notes
FROM labels
"""

TOLERANCE_M = 2.0
RELAXED_M = 5.0
MIN_AREA_M2 = 1500.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    text = sql
    for name in names:
        text = text.replace(f"FROM {name}", "FROM {" + name + "}")
    # Braces of JSON literals are doubled for the formatter of spark.sql.
    literal = text.replace("'{\"", "'{{\"").replace("\"}'", "\"}}'")
    return spark.sql(literal, **{name: table(spark, sf_dir, name) for name in names})


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The rows of a small file on all cores: policies and kernels cost far more than their bytes."""
    return df.repartition(key)


def with_box(df: DataFrame) -> DataFrame:
    return df.withColumn("rings", F.expr(G.box_rings("x0", "y0", "x1", "y1")))


def land(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_box(dealt(derive(spark, sf_dir, LAND_SQL, "part"), "component_id"))


def route_tags() -> "F.Column":
    return F.create_map(
        F.lit("highway"), F.col("highway"), F.lit("foot"), F.col("foot"), F.lit("access"), F.col("access_tag")
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = dealt(derive(spark, sf_dir, ROUTES_SQL, "orders"), "route_index").withColumn(
        "verdict", P.pedestrian(route_tags(), F.col("official"))
    )
    node = lambda c: F.when(F.col("official"), "").otherwise(F.concat(F.lit("osm:"), F.col(c)))
    return raw.select(
        "route_index", "source_id", "block", "slot", "verdict.tier", "verdict.seed", "verdict.reason",
        node("start_no").alias("start_node"), node("end_no").alias("end_node"), "grade",
        F.lit("").alias("name"), "x0", "y0", "x1", "y1",
        F.expr(G.line_path("x0", "y0", "x1", "y1")).alias("path"),
    )


def barrier_tags() -> "F.Column":
    return F.create_map(F.lit("barrier"), F.col("barrier"), F.lit("access"), F.col("access_tag"))


def barriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(derive(spark, sf_dir, BARRIERS_SQL, "customer"), "barrier_no").select(
        "barrier_no", F.col("node_no").cast("string").alias("node_id"),
        P.barrier_blocks(barrier_tags()).alias("blocking"), "x", "y", F.expr(f"array({G.point('x', 'y')})").alias("path"),
    )


def hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_box(derive(spark, sf_dir, HINTS_SQL, "supplier")).withColumn(
        "site_id", F.concat(F.lit("hint:"), "source_id")
    )


def councils(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_box(derive(spark, sf_dir, COUNCILS_SQL, "nation"))


def counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_box(derive(spark, sf_dir, COUNTIES_SQL, "region"))


def way_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, WAY_NODES_SQL, "lineitem")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, REVIEWS_SQL, "labels")
