from dataclasses import replace
import json

import pytest
from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.operators import review as W
from strollgraph.operators import sites as D
from strollgraph.plans import analyse as A
from strollgraph.plans import export as E
from strollgraph.plans import validate as V
from strollgraph.sources import readers
from worlds import ROAD, World, box, build


def test_export_run_and_its_checks(spark, tmp_path):
    inputs = build(spark, {"a": World([box(0, 0, 10, 10), box(500, 0, 520, 10), box(900, 0, 950, 30)], [ROAD, ([(5, -10), (5, 5)], "official", False)])})
    sites = A.analyse(inputs).sites.withColumn("in_core", F.lit(True))
    shapes = D.site_shapes(inputs.catalogue.membership, inputs.catalogue.components)
    candidate = sites.where("status = 'likely_access_island'").orderBy("area_ha").first()
    review = spark.createDataFrame(
        [(candidate.site_id, candidate.geometry_sha256, "confirmed", "seen", "walk", "2026-01-01"), ("gone", "0", "rejected", "", "", "")],
        "site_id string, geometry_sha256 string, review_outcome string, review_notes string, review_source string, review_date string",
    )
    out = str(tmp_path / "run")
    done = E.export_run(sites, inputs.catalogue.membership, inputs.catalogue.components, out, review, manifest={"signature": "s1"})
    assert [r.site_id for r in done["review_history"].collect()] == ["gone"]
    carried = {r.site_id: r.review_outcome for r in done["review_sample"].collect()}
    assert carried[candidate.site_id] == "confirmed" and set(carried.values()) == {"confirmed", ""}
    checks = E.check_export(spark, out, sites, shapes, sites.select("site_id"))
    assert {r["check"]: r.violations for r in checks.collect()} == dict.fromkeys(
        ["table_ids", "repeated_ids", "membership_ids", "candidate_table_ids", "candidate_shape_ids", "permissive_ids", "empty_shapes", "points_outside", "selected_inventory"], 0
    )
    V.require_clean(checks)
    assert json.loads(spark.read.text(f"{out}/run_manifest").first()[0])["signature"] == "s1"
    assert spark.read.csv(f"{out}/report/candidates", header=True).count() == 2
    total = spark.read.csv(f"{out}/report/core", header=True).where("status = 'total'").first()
    assert (total.core, total.surrounding) == ("3", "0")
    less = E.check_export(spark, out, sites.where(F.col("site_id") != candidate.site_id), shapes)
    bad = {r["check"] for r in less.where("violations > 0").collect()}
    assert bad == {"table_ids", "membership_ids", "candidate_table_ids", "candidate_shape_ids"}


def test_reviews_of_changed_shapes_are_no_reviews(spark, tmp_path):
    """The report lists desk reviews and sample outcomes of current shapes only, also when the earlier files are read from the same folder."""
    inputs = build(spark, {"a": World([box(0, 0, 10, 10), box(500, 0, 520, 10), box(900, 0, 950, 30)], [ROAD])})
    sites = A.analyse(inputs).sites
    ids = [(r.site_id, r.geometry_sha256) for r in sites.orderBy("area_ha").collect()]
    fields = "site_id string, geometry_sha256 string, review_outcome string, review_notes string, review_source string, review_date string"
    earlier = spark.createDataFrame([(*ids[0], "", "noted", "", ""), (ids[1][0], "changed", "confirmed", "", "", "")], fields)
    ledger = spark.createDataFrame(
        [(*ids[2], "g", "2026", "ok"), (ids[0][0], "changed", "g", "2026", "ok")], readers.SIDE_TABLES["ledger"]
    )
    out = str(tmp_path / "run")
    E.export_run(sites, inputs.catalogue.membership, inputs.catalogue.components, out, earlier, ledger=ledger)
    reviewed = lambda: {r.site_id for r in spark.read.csv(f"{out}/report/reviewed", header=True).collect()}
    assert reviewed() == {ids[2][0]}
    again = spark.read.csv(f"{out}/review_sample", header=True).select("site_id", "geometry_sha256", *W.REVIEW_FIELDS)
    history = spark.read.csv(f"{out}/review_history", header=True)
    E.export_run(sites, inputs.catalogue.membership, inputs.catalogue.components, out, again, history, ledger=ledger)
    assert reviewed() == {ids[2][0]} and spark.read.csv(f"{out}/review_history", header=True).count() == 1
    assert {r.site_id for r in spark.read.csv(f"{out}/review_sample", header=True).where("review_notes = 'noted'").collect()} == {ids[0][0]}


def test_a_run_reports_what_was_asked(spark):
    inputs = build(spark, {"a": World([box(0, 0, 10, 10), box(500, 0, 520, 10), box(900, 0, 950, 30)], [ROAD, ([(5, -10), (5, 5)], "official", False)])})
    square = lambda x0, x1: [[(float(x), float(y)) for x, y in [(x0, -100), (x1, -100), (x1, 100), (x0, 100), (x0, -100)]]]
    layer = spark.createDataFrame([("E1", "West", square(-100, 400)), ("E2", "East", square(400, 2000))], f"code string, name string, rings {G.RINGS}")
    sources = spark.createDataFrame([("osm", None, "2026", "abc")], "role string, version string, last_modified string, sha256 string")
    inputs = replace(inputs, counties=layer, councils=layer, sources=sources)
    whole = A.analyse(inputs)
    by = {r.site_id: r for r in whole.sites.collect()}
    assert len(by) == 3 and {r.country for r in by.values()} == {"England"} and {json.loads(r.source_versions)["osm"] for r in by.values()} == {"2026"}
    west = A.analyse(inputs, report=A.Report(authority="E1"))
    kept = west.sites.collect()
    assert len(kept) == 1 and kept[0].asDict() == by[kept[0].site_id].asDict()
    assert {r.site_id for r in west.contacts.collect()} == {r.site_id for r in west.membership.collect()} == {kept[0].site_id}
    assert {r.route_index for r in west.route_evidence.collect()} == {r.route for r in west.contacts.collect()}
    east = A.analyse(inputs, report=A.Report(box=(510.0, 0.0, 600.0, 5.0)))
    assert east.sites.count() == 1 and east.contacts.count() == 0 and east.route_evidence.count() == 0
    listed = spark.createDataFrame([(kept[0].site_id,), ("other",)], "site_id string")
    assert A.analyse(inputs, report=A.Report(region_sites=listed)).sites.count() == 1
    with pytest.raises(ValueError):
        A.analyse(inputs, report=A.Report(authority="E9"))
