"""Costly kernels do not stay in the one task that a small file is read by, and derived rings are not broadcast."""

from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.operators import sites as D
from strollgraph.operators import spatial as S


def boxes(spark, n):
    return spark.range(n).selectExpr("concat('s', id) as component_id", f"{G.box_rings('id * 300', '0', 'id * 300 + 10', '10')} as rings").coalesce(1)


def used(df):
    return df.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).filter(lambda n: n > 0).count()


def test_rows_of_one_partition_are_dealt(spark):
    pieces = S.polygon_pieces(boxes(spark, 20000))
    assert used(pieces) > 1
    small = pieces.select("component_id", *S.BOUNDS).coalesce(1)
    assert used(S.near_pairs(small, small)) > 1


def test_rings_are_not_broadcast(spark):
    land = boxes(spark, 50).unionByName(boxes(spark, 3).withColumn("component_id", F.concat(F.lit("t"), "component_id")))
    copies = D.collapse_copies(land)
    assert {r.component_id: r.rep for r in copies.collect() if r.component_id != r.rep} == {"ts0": "s0", "ts1": "s1", "ts2": "s2"}
    plan = copies._jdf.queryExecution().sparkPlan().toString()
    assert copies.count() == 53
    derived = [line for line in plan.splitlines() if "Join" in line and "rings" in line and "LeftSemi" not in line]
    assert len(derived) == 1 and "FileScan parquet" in plan


def test_pieces_spread_over_cells_are_not_broadcast(spark):
    """Twenty boxes are a small file and 30 MB once every cell of them holds a row."""
    boxes = spark.range(20).selectExpr("id", f"{G.box_rings('id * 20000 + 100', '100', 'id * 20000 + 19900', '19900')} as rings")
    pieces = S.polygon_pieces(boxes)
    segments = S.outline_segments(pieces, ["id"])
    pairs = S.near_pairs(segments, pieces.select("id", "edges", *S.BOUNDS)).select("a_id", "b_id", "b_edges")
    assert len(pairs.collect()) == 80
    final = pairs._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Join" in final and "BuildRight" not in final
