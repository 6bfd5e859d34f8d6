"""Tables that several steps read are made once, and the rows of a small file are dealt to all cores before costly expressions."""

import pytest
from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.lattice.context import Lattice
from strollgraph.operators import sites as D
from strollgraph.operators import spatial as S


def boxes(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("land:"), "id").alias("component_id"), F.lit("s").alias("source_id"), F.lit("").alias("name"),
        F.lit("{}").alias("source_attributes"), F.expr(G.box_rings("id * 10", "0", "id * 10 + 10", "10")).alias("rings"),
    )


def test_kernels_of_whole_polygons_run_once(spark):
    pieces = S.polygon_pieces(boxes(spark, 5).select("component_id", "rings"))
    assert pieces.count() == 5
    assert pieces.inputFiles() and all("/stage-" in f for f in pieces.inputFiles())


def test_outline_of_the_catalogue_is_read_not_derived(spark):
    made = D.form_sites(boxes(spark, 5))
    assert made.sites.count() == 1
    plan = made.outline._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_inputs_of_a_lattice_are_tables(spark):
    x = Lattice(spark, "/root/testdata/sf0.001")
    for table in (x.land, x.routes, x.barriers):
        assert table.inputFiles() and all("/stage-" in f for f in table.inputFiles())


def test_graph_takes_the_stored_shapes(spark, monkeypatch):
    from strollgraph.lattice import context as X

    x = X.Lattice(spark, "/root/testdata/sf0.001")
    x.shapes
    monkeypatch.setattr(X.A, "graph_shapes", None)  # made before, so not made again
    assert x.graph.shapes is x.shapes


def test_route_pieces_keep_seams(spark):
    from strollgraph.functions import geometry as G
    from strollgraph.operators import network as N

    paths = [[(10.0, 10.0), (90.0, 90.0)], [(50.0, 100.0), (150.0, 100.0)], [(100.0, 20.0), (100.0, 20.5)], [(-5.0, 0.0), (0.0, 0.0)]]
    routes = spark.createDataFrame(list(enumerate(paths)), f"route_index int, path {G.PATH}")
    got = {(r.route_index, r.tile_x, r.tile_y, *r.s) for r in N.route_pieces(routes, 100.0, ["route_index"]).collect()}
    assert got == {
        (0, 0, 0, 10.0, 10.0, 90.0, 90.0),
        *[(1, tx, ty, *ends) for ty in (0, 1) for tx, ends in ((0, (50.0, 100.0, 100.0, 100.0)), (1, (100.0, 100.0, 150.0, 100.0)))],
        (2, 0, 0, 100.0, 20.0, 100.0, 20.5), (2, 1, 0, 100.0, 20.0, 100.0, 20.5),
        *[(3, -1, ty, -5.0, 0.0, 0.0, 0.0) for ty in (-1, 0)], *[(3, 0, ty, 0.0, 0.0, 0.0, 0.0) for ty in (-1, 0)],
    }


def test_shapes_come_from_the_pieces_of_the_catalogue(spark, monkeypatch):
    from strollgraph.plans import analyse as A

    land = boxes(spark, 3).unionByName(boxes(spark, 1).withColumn("component_id", F.lit("twin")))
    made = D.form_sites(land)
    plain = D.site_shapes(made.membership, made.components)
    rows = lambda df: sorted(map(str, df.select("node", "edges", "whole", *S.BOUNDS).collect()))
    want = rows(plain)
    monkeypatch.setattr(S, "polygon_pieces", None)
    assert rows(A.graph_shapes(made, None)) == want and len(want) == 3


def test_contacts_under_bridges_choose_their_routes_before_the_join(spark, monkeypatch):
    from strollgraph.lattice import queries_graph as Q

    x, tiers = Lattice(spark, "/root/testdata/sf0.001"), []
    facts = Q.N.contact_facts

    def seen(shapes, routes, *sizes):
        tiers.extend(map(tuple, routes.select("tier", "grade").distinct().collect()))
        return facts(shapes, routes, *sizes)

    monkeypatch.setattr(Q.N, "contact_facts", seen)
    monkeypatch.setattr("strollgraph.lattice.registry.lattice", lambda spark, sf_dir: x)
    Q.query.__globals__["QUERIES"]["c6_contacts_under_bridges"](spark, x.sf_dir)
    assert tiers == [("official", Q.N.FLAT_GRADE)]


def test_coverage_gaps_make_no_routes(spark, monkeypatch):
    from strollgraph.lattice.registry import QUERIES

    x = Lattice(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr("strollgraph.lattice.registry.lattice", lambda spark, sf_dir: x)
    QUERIES["c10_coverage_gaps"](spark, x.sf_dir)
    assert "routes" not in x.__dict__ and "barriers" not in x.__dict__


@pytest.fixture(scope="module")
def reported(spark):
    """A lattice that several queries on the classified sites share."""
    return Lattice(spark, "/root/testdata/sf0.001")


def queried(x, monkeypatch, name):
    from strollgraph.lattice.queries import QUERIES

    monkeypatch.setattr("strollgraph.lattice.registry.lattice", lambda spark, sf_dir: x)
    return QUERIES[name](x.spark, x.sf_dir).collect()


def test_desk_reviews_label_and_search_nothing(reported, monkeypatch):
    rows = queried(reported, monkeypatch, "c23_desk_reviews")
    assert len(rows) == 1 and "labelled" not in reported.__dict__


def test_site_search_needs_status_and_labels_only(reported, monkeypatch):
    queried(reported, monkeypatch, "b32_site_search")
    assert "authority_labels" in reported.__dict__ and "labelled" not in reported.__dict__


def test_stored_labels_equal_those_of_the_run(reported, monkeypatch):
    from strollgraph.lattice import context as X

    x = reported
    columns = ["site_id", "council", "council_code", "all_councils", "county", "county_code", "all_counties"]
    want = sorted(map(str, X.A.label(x.classified, x.inputs, x.graph, x.settings).select(*columns).collect()))
    assert sorted(map(str, x.with_authorities(x.classified).select(*columns).collect())) == want
    monkeypatch.setattr(X.A, "authority_labels", None)  # made before, so not made again
    again = X.A.label(x.classified, x.inputs, x.graph, x.settings, labels=x.authority_labels)
    assert sorted(map(str, again.select(*columns).collect())) == want


def test_run_checks_label_and_search_nothing(reported, monkeypatch):
    rows = queried(reported, monkeypatch, "p13_run_checks")
    assert len(rows) == 4 and not any(r.violations for r in rows) and "labelled" not in reported.__dict__


def test_points_meet_their_own_land_only(spark, monkeypatch):
    from strollgraph.operators import overlay as O
    from strollgraph.plans import validate as V

    land = boxes(spark, 1).crossJoin(spark.range(3).select(F.concat(F.lit("n"), "id").alias("node"))).select("node", "rings")
    points = spark.createDataFrame([("n0", 5.0, 5.0), ("n1", 50.0, 5.0)], "site_id string, easting double, northing double")
    pairs, linked = [], O.S.link_distance
    monkeypatch.setattr(O.S, "link_distance", lambda df, d: pairs.append(df.count()) or linked(df, d))
    assert [r.site_id for r in V.points_outside(points, S.polygon_pieces(land)).collect()] == ["n1"]
    assert pairs == [1]


def test_reported_sites_need_no_graph(spark, monkeypatch):
    x = Lattice(spark, "/root/testdata/sf0.001")
    queried(x, monkeypatch, "c22_reported_sites")
    assert not {"routes", "graph", "classified", "labelled"} & set(x.__dict__)


def test_report_rows_label_and_search_nothing(reported, monkeypatch):
    rows = queried(reported, monkeypatch, "p14_report_rows")
    assert rows and "labelled" not in reported.__dict__


def test_report_tables_search_nothing(reported, monkeypatch):
    rows = queried(reported, monkeypatch, "p14_report_tables")
    assert rows and "labelled" not in reported.__dict__
