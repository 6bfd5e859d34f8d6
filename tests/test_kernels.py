"""The array kernels of pairs give what the expressions of ``geometry`` give, to the last bit."""

import random

from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.functions import kernels as M
from strollgraph.operators import spatial as S


def pairs(spark):
    """Segments and points against concave polygons, with vertices and edges that meet and a drawn edge."""
    rng = random.Random(7)
    rows = []
    for i in range(400):
        n = rng.choice([3, 4, 5, 9])
        whole = i % 2 == 0
        spot = lambda: (float(rng.randint(0, 8)), float(rng.randint(0, 8))) if whole else (rng.uniform(0, 9), rng.uniform(0, 9))
        ring = [spot() for _ in range(n)]
        edges = [(*p, *q, k == 1 and i % 3 == 0) for k, (p, q) in enumerate(zip(ring, ring[1:] + ring[:1]))]
        a = spot()
        b = a if i % 5 == 0 else spot()
        rows.append((i, (*a, *b), edges if i % 40 else []))
    edge = "x0:double,y0:double,x1:double,y1:double"
    return spark.createDataFrame(rows, f"i int, a_s struct<{edge}>, b_edges array<struct<{edge},drawn:boolean>>")


def test_kernels_equal_expressions(spark, monkeypatch):
    # Several parts of a batch, too.
    monkeypatch.setattr(M, "PART_EDGES", 50)
    df = pairs(spark).repartition(3)
    covered = G.with_cover(df, "a_s", "b_edges")
    want = sorted(S.explode_spans(covered.drop("b_edges")).select("i", "is_left", "t0", "t1").collect())
    got = sorted(M.cover_rows(df, "a_s", "b_edges").select("i", "is_left", "t0", "t1").collect())
    assert len(want) > 200 and got == want

    point = f"a_s.x0 = a_s.x1 and a_s.y0 = a_s.y1 and {G.point_in_polygon('a_s.x0', 'a_s.y0', 'b_edges')}"
    start = "named_struct('d2', 0D, 'px', a_s.x0, 'py', a_s.y0, 'qx', a_s.x0, 'qy', a_s.y0)"
    for distance in (0.0, 2.0):
        near = G.nearest_link("a_s", G.edges_near(G.outline_edges("b_edges"), "a_s", distance))
        plain = covered.withColumn("link", F.expr(f"if(size(left) + size(right) > 0 or ({point}), {start}, {near})"))
        columns = ["i", "left", "right", "link"]
        want = sorted(plain.where(F.col("link.d2") <= distance**2).select(*columns).collect(), key=lambda r: r.i)
        linked = S.link_distance(df, distance)
        got = sorted(linked.select(*columns).collect(), key=lambda r: r.i)
        assert len(want) > 100 and got == want


def test_pairs_are_measured_by_the_batch(spark):
    df = pairs(spark)
    text = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in text(S.link_distance(df, 1.0))
    # Only pairs that are near come back, and without their edges.
    assert "b_edges" not in S.link_distance(df, 1.0).columns
