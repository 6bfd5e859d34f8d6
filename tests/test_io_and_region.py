import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.functions import text as T
from strollgraph.operators import classify as K
from strollgraph.operators import labels as L
from strollgraph.operators import network as N
from strollgraph.operators import review as W
from strollgraph.operators import sites as D
from strollgraph.operators import spatial as S
from strollgraph.plans import analyse as A
from strollgraph.plans import region as Z
from strollgraph.plans import validate as V
from strollgraph.sources import readers, writers
from strollgraph.streaming import incremental as I
from worlds import ROAD, World, box, build

LAND = f"component_id string, source_id string, name string, source_attributes string, rings {G.RINGS}"


def land(spark, boxes):
    return spark.createDataFrame([(f"land:{i}", f"land:{i}", "", "{}", b) for i, b in enumerate(boxes)], LAND)


def test_nearest_route_uses_the_whole_site_and_keeps_its_limit(spark):
    catalogue = D.form_sites(land(spark, [box(0, 0, 50000, 10), box(100000, 0, 100010, 10)]))
    shapes = D.site_shapes(catalogue.membership, catalogue.components)
    routes = spark.createDataFrame([([(50030.0, 0.0), (50030.0, 10.0)],), ([(107010.0, 0.0), (107010.0, 10.0)],)], f"path {G.PATH}")
    rows = L.nearest_routes(shapes, routes).join(catalogue.sites, "site_id").orderBy(F.desc("area_ha")).collect()
    assert [r["nearest_mapped_route_m"] for r in rows] == [30.0, None]
    assert {r[1] for r in L.nearest_routes(shapes, routes, limit=20).collect()} == {None}


def test_study_buffer_and_core(spark):
    catalogue = D.form_sites(land(spark, [box(2, 0, 12, 10), box(40, 0, 50, 10), box(1000, 0, 1010, 10)]))
    shapes = D.site_shapes(catalogue.membership, catalogue.components)
    study = spark.createDataFrame([("S", "Study", box(0, 0, 20, 20))], f"code string, name string, rings {G.RINGS}")
    rows = Z.select_sites(shapes, catalogue.outline, study, 100.0).collect()
    assert len(rows) == 2 and sum(r["in_core"] for r in rows) == 1


@pytest.mark.parametrize("bad", [(-1.0, 1.0, 2.0), (float("inf"), 1.0, 2.0), (float("nan"), 1.0, 2.0), (0.0, 0.0, 2.0), (0.0, 5.0, 2.0)])
def test_buffer_guards(bad):
    with pytest.raises(ValueError):
        Z.check_buffers(*bad)


def test_box_guard():
    with pytest.raises(ValueError):
        Z.check_box(10, 0, 0, 10)


@pytest.mark.parametrize("start,maximum,expected", [(100.0, 100.0, "uncertain"), (1600.0, 4000.0, "access_evidenced")])
def test_context_grows_until_the_edge_is_resolved(spark, start, maximum, expected):
    """A path leaves the first context; its road lies 3 km away."""
    inputs = build(spark, {"w": World([box(0, 0, 10, 10)], [
        ([(5, 5), (3000, 5)], "public", False, "1", "2"), ([(3000, 5), (3000, 100)], "inferred", True, "2", "3"),
    ])})
    study = spark.createDataFrame([("S", "Study", box(-5, -5, 15, 15))], f"code string, name string, rings {G.RINGS}")

    def attempt(buffer_m):
        run = Z.prepare_region(inputs, study, buffer_m)
        graph = A.build_graph(run, A.Settings())
        return A.classify(run, graph, A.Settings()), f"{buffer_m}", False

    sites, used = Z.expand_context(attempt, start, maximum)
    row = sites.first()
    assert row["status"] == expected
    assert ("regional_context_incomplete" in row["reasons"]) == (expected == "uncertain")
    assert used == (100.0 if maximum == 100.0 else 3200.0)


def test_incremental_tiles_resume(spark, tmp_path):
    inputs = build(spark, {"a": World([box(95, 95, 105, 105)], [([(50, 80), (150, 80)], "inferred", True, "1", "2"), ([(100, 80), (100, 100)], "official", False)])})
    shapes = A.graph_shapes(inputs.catalogue, None)
    full = N.tile_contacts(shapes, inputs.routes, inputs.barriers, 5.0, 100.0)
    args = (shapes, inputs.routes, inputs.barriers, 5.0, 100.0, str(tmp_path / "tiles"))
    first = I.contacts_by_tile(*args, "s1", only=lambda t: t.where("tile_x = 0"))
    resumed = I.contacts_by_tile(*args, "s1")
    key = lambda df: sorted(map(tuple, df.select("node", "route_index", "tile_x", "tile_y", "distance", "weak").collect()))
    assert 0 < len(key(first)) <= len(key(resumed))
    assert key(resumed) == key(full)
    assert I.open_tiles(I.route_tiles(inputs.routes, 100.0), args[-1], "s1").isEmpty()
    assert not I.open_tiles(I.route_tiles(inputs.routes, 100.0), args[-1], "s2").isEmpty()
    broken = tmp_path / "broken"
    (broken / "s1" / "ledger").mkdir(parents=True)
    with pytest.raises(AnalysisException):  # a folder without a table is damage, not a fresh start
        I.open_tiles(I.route_tiles(inputs.routes, 100.0), str(broken), "s1")
    moved = spark.createDataFrame([(90.0, 90.0, 95.0, 95.0)], "xmin double, ymin double, xmax double, ymax double")
    assert {tuple(r) for r in I.refresh_tiles(moved, 100.0, 5.0).collect()} == {(0, 0), (0, 1), (1, 0), (1, 1)}


def test_layers_tables_and_geojson(spark, tmp_path):
    inputs = build(spark, {"a": World([box(0, 0, 10, 10), box(500, 0, 520, 10)], [ROAD, ([(5, -10), (5, 5)], "official", False)])})
    result = A.analyse(inputs)
    out = str(tmp_path)
    sites = result.sites
    writers.write_layers({"sites": sites, "rejected": sites.where("false")}, out)
    assert readers.read_features(spark, f"{out}/sites").count() == 2
    with pytest.raises(ValueError):
        readers.read_features(spark, f"{out}/rejected")
    assert spark.read.parquet(f"{out}/rejected").columns == sites.columns
    writers.write_site_tables(sites, f"{out}/csv")
    table = spark.read.csv(f"{out}/csv/sites", header=True)
    assert {r[0] for r in table.select("site_id").collect()} == {r[0] for r in sites.select("site_id").collect()}
    assert spark.read.csv(f"{out}/csv/likely_access_islands", header=True).count() == 1
    polygons = writers.site_polygons(inputs.catalogue.membership, inputs.catalogue.components)
    writers.write_candidates_geojson(sites, polygons, out)
    features = readers.read_features(spark, f"{out}/likely_access_islands.geojson", "geojson", readers.LONLAT_CRS)
    row = features.selectExpr("attributes['site_id'] id", f"{G.polygon_area('polygons[0]')} a", "polygons[0][0][0].x x").first()
    assert row["a"] == pytest.approx(200.0, abs=0.05) and row["x"] == pytest.approx(500.0, abs=0.01)
    assert row["id"] == sites.where("status = 'likely_access_island'").first()["site_id"]
    writers.write_partitioned_polygons(sites, polygons, out)
    assert {r[0] for r in spark.read.parquet(f"{out}/polygons").select("partition").distinct().collect()} == {"0_0"}
    shapes = D.site_shapes(inputs.catalogue.membership, inputs.catalogue.components)
    checks = V.validate_run(sites, inputs.catalogue.membership, inputs.catalogue.sites, shapes)
    V.require_clean(checks)
    with pytest.raises(ValueError):
        V.require_clean(V.validate_run(sites, inputs.catalogue.membership.limit(1), inputs.catalogue.sites, shapes))


def test_geojson_collection_side_tables_and_digests(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "id": "1", "properties": {"name": "A"}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [3, 4]]}},
        {"type": "Feature", "id": "2", "properties": {"name": "B"}, "geometry": {"type": "Point", "coordinates": [7, 8, 9]}},
        {"type": "Feature", "id": "3", "properties": {"name": "C"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [2, 0], [2, 2], [0, 0]]]]}},
    ]}
    (tmp_path / "layer.json").write_text(json.dumps(doc))
    rows = readers.read_features(spark, str(tmp_path / "layer.json"), "geojson_collection").orderBy("feature_id")
    got = rows.selectExpr(f"{G.path_length('lines[0]')} l", "points[0].y y", f"{G.polygon_area('polygons[0]')} a").collect()
    assert got[0]["l"] == 5.0 and got[1]["y"] == 8.0 and got[2]["a"] == 2.0
    with pytest.raises(ValueError):
        readers.read_features(spark, str(tmp_path / "layer.json"), "geojson_collection", None)
    (tmp_path / "m.csv").write_text("site_id,component_id\ns,c\n")
    assert readers.read_side_table(spark, str(tmp_path / "m.csv"), "membership").first()["component_id"] == "c"
    import hashlib

    digests = readers.file_digests(spark, str(tmp_path), "*.csv")
    assert digests.first()["sha256"] == hashlib.sha256(b"site_id,component_id\ns,c\n").hexdigest()
    assert len(readers.folder_digest(digests).first()[0]) == 64
    sources = spark.createDataFrame([("osm", None, "2026", "abc"), ("land", "v1", None, "def")], "role string, version string, last_modified string, sha256 string")
    assert json.loads(readers.source_versions(sources).first()[0]) == {"land": "v1", "osm": "2026"}


def test_reviews_stay_with_their_shape(spark):
    rows = [(f"s{i:02d}", "likely_access_island", float(100 - i), f"g{i}") for i in range(21)]
    sites = spark.createDataFrame(rows, "site_id string, status string, area_ha double, geometry_sha256 string")
    earlier = spark.createDataFrame(
        [("s20", "g20", "compared", "keep", "", ""), ("s03", "older", "entrance checked", "", "", "")],
        "site_id string, geometry_sha256 string, review_outcome string, review_notes string, review_source string, review_date string",
    )
    sample, lost = W.carry_reviews(sites, earlier)
    got = {r["site_id"]: r["review_outcome"] for r in sample.collect()}
    assert len(got) == 11 and got["s20"] == "compared" and got["s03"] == ""
    assert [r["site_id"] for r in lost.collect()] == ["s03"]
    assert W.append_history(lost, lost).count() == 1


def test_unknown_authority(spark):
    codes = spark.createDataFrame([("E1", "One"), ("E2", "ONE")], "code string, name string")
    ask = lambda item: Z.resolve_authorities(codes, spark.createDataFrame([(item,)], "item string"))
    assert Z.require_resolved(ask("E1")).first()["name"] == "One"
    for item in ("one", "missing"):
        with pytest.raises(ValueError):
            Z.require_resolved(ask(item))
    with pytest.raises(ValueError):
        Z.report_filter(codes, None, codes, authority="E9")


def test_variants():
    chosen = K.variants(7.0)
    assert [v.tolerance for v in chosen] == [0.0, 7.0, 7.0, 0.0, 7.0, 7.0, 7.0]
    assert [v.weak for v in chosen] == [False] * 6 + [True]


def test_hot_cell_keeps_every_pair(spark):
    rows = [(i, [(float(i % 7), 0.0), (float(i % 7), 9.0)]) for i in range(300)]
    lines = spark.createDataFrame(rows, f"i int, path {G.PATH}")
    one = S.path_segments(lines, ["i"]).drop("edge_no")
    pairs = S.near_pairs(one, one, 0.0, condition=F.col("a_i") < F.col("b_i"))
    assert pairs.count() == pairs.select("a_i", "b_i").distinct().count() == sum(
        1 for i in range(300) for j in range(i + 1, 300) if i % 7 == j % 7
    )


def test_exports_and_texts_lose_nothing(spark, tmp_path):
    nested = spark.createDataFrame([(1, ["a", "b"], {"k": "v"})], "id int, list array<string>, tags map<string,string>")
    assert tuple(writers.flat_columns(nested).first()) == (1, '["a","b"]', '{"k":"v"}')
    names = spark.createDataFrame([({"name": "Nan", "level": "NaN"},)], "m map<string,string>")
    assert json.loads(names.select(T.attributes_json(F.col("m"))).first()[0]) == {"name": "Nan", "level": None}
    path = str(tmp_path / "lines.geojson")
    with open(path, "w") as out:
        out.write('{"type": "FeatureCollection", "features": [\n{"id": "a", "properties": {"n": "1"}},\n')
        out.write('{"id": "b", "properties": {}, "geometry": {"type": "Point", "coordinates": [1, 2]}}\n]}\n')
    rows = readers.read_features(spark, path, "geojson").orderBy("feature_id").collect()
    assert [(r.feature_id, r.kind) for r in rows] == [("a", None), ("b", "Point")]
    boxes = land(spark, [box(0, 0, 10, 10), box(10, 0, 20, 10), box(10, 0, 20, 10)])
    catalogue = D.form_sites(boxes)
    polygons = writers.site_polygons(catalogue.membership, boxes)
    assert polygons.count() == polygons.select("site_id", "component_id").distinct().count() == 3
