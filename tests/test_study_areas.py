import pytest

from strollgraph.functions import geometry as G
from strollgraph.operators import sites as D
from strollgraph.plans import region as Z
from worlds import box

SQUARE = box(0, 0, 10000, 10000)
SLOPE = [[(5000.0, 0.0), (15000.0, 0.0), (5000.0, 10000.0), (5000.0, 0.0)]]
HOLED = box(0, 0, 10000, 10000) + [[(4000.0, 4000.0), (4000.0, 6000.0), (6000.0, 6000.0), (6000.0, 4000.0), (4000.0, 4000.0)]]


def layers(spark):
    rows = [("C1", "Upper", SQUARE), ("C1", "Upper", SQUARE), ("D2", "Lower", SLOPE), ("D3", "Ring", HOLED)]
    return spark.createDataFrame(rows, f"code string, name string, rings {G.RINGS}")


def made(spark, asked, boxes=None):
    wanted = spark.createDataFrame(asked, "study string, item string")
    windows = None if boxes is None else spark.createDataFrame(boxes, "study string, x0 int, y0 int, x1 int, y1 int")
    return Z.study_areas(layers(spark), wanted, windows)


def test_several_authorities_dissolve_and_are_cut_to_their_box(spark):
    asked = [("whole", "C1"), ("whole", "lower"), ("whole", "UPPER"), ("part", "C1"), ("part", "D2"), ("ring", "D3")]
    areas = made(spark, asked, [("part", 2000, 2000, 12000, 8000), ("ring", 0, 0, 6000, 10000), ("own", 100, 200, 300, 600)])
    got = {r["code"]: r for r in areas.areas.collect()}
    assert {c: (r["authorities"], round(r["area_m2"], 3)) for c, r in got.items()} == {
        "whole": (2, 112.5e6), "part": (2, 52e6), "ring": (1, 56e6), "own": (0, 80000.0),
    }
    assert [got["part"][c] for c in ("xmin", "ymin", "xmax", "ymax")] == [2000, 2000, 12000, 8000]
    assert {tuple(r) for r in areas.members.where("study = 'whole'").collect()} == {("whole", "C1", "Upper"), ("whole", "D2", "Lower")}
    # The pieces are the same areas again, and stand for polygons in the selection.
    area = areas.pieces.selectExpr("code", f"{G.signed_area('edges')} as a").groupBy("code").sum("a").collect()
    assert {c: round(a, 3) for c, a in area} == {c: round(r["area_m2"], 3) for c, r in got.items()}
    land = [box(0, 0, 10, 10), box(1990, 3000, 2000, 3010), box(1990, 4000, 2001, 4010), box(11999, 7000, 12010, 7010), box(10500, 2500, 10510, 2510), box(4500, 4500, 4600, 4600)]
    catalogue = D.form_sites(spark.createDataFrame([(str(i), str(i), "", "{}", b) for i, b in enumerate(land)], f"component_id string, source_id string, name string, source_attributes string, rings {G.RINGS}"))
    shapes = D.site_shapes(catalogue.membership, catalogue.components)
    hits = Z.select_sites(shapes, catalogue.outline, areas.pieces).join(catalogue.membership, "site_id").select("code", "component_id")
    assert {tuple(r) for r in hits.collect()} == {
        *[("whole", i) for i in "01245"], *[("part", i) for i in "245"], *[("ring", i) for i in "012"],
    }


def test_bad_requests_are_named(spark):
    with pytest.raises(ValueError, match="Unknown or ambiguous authority 'Nowhere'"):
        made(spark, [("a", "Nowhere")])
    with pytest.raises(ValueError, match="Study area 'hole' is empty"):
        made(spark, [("hole", "D3")], [("hole", 4000, 4000, 6000, 6000)])
    with pytest.raises(ValueError, match="west < east"):
        made(spark, [("a", "C1")], [("a", 5, 0, 5, 10)])


def test_a_source_limits_a_study_by_distance(spark):
    areas = made(spark, [("near", "C1"), ("near", "D2"), ("far", "D2")])
    hole = [[(16000.0, 16000.0), (16000.0, 17000.0), (17000.0, 17000.0), (17000.0, 16000.0), (16000.0, 16000.0)]]
    # Two extracts side by side: their common edge is no limit.
    extracts = [box(-50000, -50000, 3000, 50000), box(3000, -50000, 50000, 50000) + hole]
    source = lambda rings: spark.createDataFrame([(r,) for r in rings], f"rings {G.RINGS}")
    none = areas.pieces.where("false")

    def limited(rings, context_m, study_m=0.0, extents=none):
        return {r["code"] for r in Z.limited_by_source(areas, extents, source(rings), context_m, study_m).where("limited").collect()}

    reach = 2**0.5 * 6000  # from the corner of the square to the hole
    assert limited(extracts, reach - 0.01) == set()
    assert limited(extracts, reach + 0.01) == {"near"}
    assert limited(extracts, reach - 500, 501.0) == {"near"}
    assert limited([box(60000, 0, 61000, 1000)], 100.0) == {"near", "far"}
    site = areas.pieces.sparkSession.createDataFrame([("far", box(15500, 14000, 15600, 14100))], f"code string, rings {G.RINGS}")
    assert limited(extracts, 1950.0, 0.0, Z.study_pieces(site)) == {"far"}


def test_a_study_buffer_widens_the_context_of_the_study_only(spark):
    study = spark.createDataFrame([("s", box(0, 0, 100, 100))], f"code string, rings {G.RINGS}")
    site = Z.study_pieces(spark.createDataFrame([("node-1", box(90, 0, 300, 100))], f"code string, rings {G.RINGS}")).withColumnRenamed("code", "node")
    chosen = spark.createDataFrame([("s", "node-1")], "code string, site_id string")
    extents = Z.context_extents(study, site, chosen)
    # Left of the study 0 within 50, 1 at 100 within buffer and study buffer, 2 beyond both; right of the site 3 within 50, 4 beyond; 5 crosses the edge.
    paths = [(-40, -30), (-100, -90), (-170, -160), (320, 330), (360, 370), (-160, -60)]
    routes = spark.createDataFrame([(i, [(float(a), 50.0), (float(b), 50.0)]) for i, (a, b) in enumerate(paths)], f"route_index bigint, path {G.PATH}")
    found = lambda df: {r["route_index"] for r in df.collect()}
    near = Z.context_routes(routes, extents, 50.0, 100.0)
    assert found(near) == {0, 1, 3, 5}
    assert found(Z.context_routes(routes, extents, 50.0)) == {0, 3}
    assert found(Z.cut_routes(routes, near, extents, 50.0, 100.0)) == {5}
    assert found(Z.cut_routes(routes, near, extents, 50.0)) == {1, 5}
