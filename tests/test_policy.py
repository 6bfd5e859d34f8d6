"""One case per rule of the decision table and per side of each boundary between rules, over whole vocabularies."""

from itertools import product

import pytest
from pyspark.sql import functions as F

from strollgraph.functions import policy as P

OTHER_HIGHWAYS = ["bridleway", "steps", "service", "corridor"]


def tags(**given):
    return {k.replace("__", ":"): v for k, v in given.items()}


def cases():
    """(tags, tier, seed, reason) in the order of the rules."""
    for h, f in product(P.PROHIBITED_HIGHWAYS, ["designated", "customers", ""]):
        yield tags(highway=h, foot=f, designation="restricted_byway"), "excluded", False, "pedestrian_prohibited"
    for d, f in product(P.PUBLIC_DESIGNATIONS, P.BLOCKED_VALUES):
        yield tags(highway="steps", designation=d, foot=f), "unknown", False, "conflicting_access_tags"
    for h, a in product(["bridleway", "tertiary"], P.BLOCKED_VALUES):
        yield tags(highway=h, access=a), "excluded", False, "pedestrian_prohibited"
        yield tags(highway=h, access=a, designation="restricted_byway"), "excluded", False, "pedestrian_prohibited"
        yield tags(highway=h, access="official", foot=a), "excluded", False, "pedestrian_prohibited"
    for h in P.ROAD_HIGHWAYS + OTHER_HIGHWAYS:
        road = h in P.ROAD_HIGHWAYS
        yield tags(highway=h, access__conditional="yes @ summer"), "unknown", road, "conditional_access"
        yield tags(highway=h, foot="official", foot__conditional="x"), "unknown", road, "conditional_access"
        yield tags(highway=h, foot="permissive", designation="restricted_byway"), "permissive", False, "permissive_only"
        yield tags(highway=h, access="permissive"), "permissive", False, "permissive_only"
        for a in P.ALLOWED_VALUES:
            yield tags(highway=h, access=a), "public", road, ""
            yield tags(highway=h, access="delivery", foot=a), "public", road, ""
        yield tags(highway=h, designation="byway_open_to_all_traffic"), "public", road, ""
        yield tags(highway=h), ("inferred" if road else "unknown"), road, ("road_access_inferred" if road else "access_not_recorded")
        yield tags(highway=h, foot="", access=""), ("inferred" if road else "unknown"), road, ("road_access_inferred" if road else "access_not_recorded")
        yield tags(highway=h, access="unsigned"), "unknown", False, "access_not_recorded"
    yield tags(designation="byway_open_to_all_traffic"), "public", False, ""
    yield tags(surface="gravel"), "unknown", False, "access_not_recorded"


def test_every_rule_of_the_way_table(spark):
    listed = list(cases())
    frame = spark.createDataFrame([(i, c[0]) for i, c in enumerate(listed)], "i int, tags map<string,string>")
    rows = frame.select("i", P.pedestrian(F.col("tags")).alias("v")).orderBy("i").collect()
    wrong = [(c, r["v"]) for c, r in zip(listed, rows) if (r["v"]["tier"], r["v"]["seed"], r["v"]["reason"]) != c[1:]]
    assert not wrong
    official = frame.select(P.pedestrian(F.col("tags"), F.lit(True)).alias("v")).distinct().collect()
    assert [(r["v"]["tier"], r["v"]["seed"], r["v"]["reason"]) for r in official] == [("official", False, "")]


def test_every_kind_of_barrier(spark):
    listed = []
    for kind in [*P.PASSABLE_BARRIERS, "hedge", "ditch"]:
        listed += [(tags(barrier=kind, access=a), True) for a in P.BLOCKED_VALUES]
        listed += [(tags(barrier=kind, access="no", foot=a), False) for a in P.ALLOWED_VALUES]
        listed += [(tags(barrier=kind, foot="permissive"), kind not in P.PASSABLE_BARRIERS), (tags(barrier=kind), kind not in P.PASSABLE_BARRIERS)]
    listed += [(tags(access="agricultural"), True), (tags(surface="gravel"), False)]
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(listed)], "i int, tags map<string,string>")
    rows = frame.select("i", P.barrier_blocks(F.col("tags")).alias("b")).orderBy("i").collect()
    assert [r["b"] for r in rows] == [b for _, b in listed]


def test_grade(spark):
    frame = spark.createDataFrame([(tags(layer="-1", tunnel="culvert"),), (tags(bridge="viaduct"),), (tags(width="2"),)], "tags map<string,string>")
    assert [r[0] for r in frame.select(P.grade(F.col("tags"))).collect()] == ["-1:no:culvert", "0:viaduct:no", "0:no:no"]


@pytest.mark.parametrize("key", P.COMMON_KEYS)
def test_common(spark, key):
    frame = spark.createDataFrame([({key: "common"},), ({key: "Common land"},), ({"name": "common"},)], "tags map<string,string>")
    assert [r[0] for r in frame.select(P.is_common(F.col("tags"))).collect()] == [True, False, False]
