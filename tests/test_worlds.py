import pytest
from worlds import ROAD, World, box, run

SQUARE = box(0, 0, 10, 10)
OFFICIAL = ([(5, -10), (5, 5)], "official", False)


def approach(tier, end=5):
    return ([(5, -10), (5, end)], tier, False, "1", "3")


def grade_world(grade, shadow):
    routes = [([(-20, 5), (50, 5)], "inferred", True, "1", "2", grade)]
    return World([SQUARE], routes + ([([(-20, 5), (50, 5)], "official", False)] if shadow else []))


FAR = ([(-20, -100), (400, -100)], "inferred", True, "1", "2")
WORLDS = {
    "adjoining": World([SQUARE, box(10, 0, 20, 10), box(100, 0, 110, 10)], [ROAD, OFFICIAL, ([(101, 5), (109, 5)], "official", False)]),
    "corner": World([SQUARE, box(10, 10, 20, 20)], [FAR]),
    "small": World([box(0, 0, 1, 1), box(100, 0, 111, 9), box(200, 0, 210, 10)], [FAR]),
    "tiny_access": World([box(0, 0, 1, 1)], [ROAD, ([(0.5, -10), (0.5, 0.5)], "official", False)]),
    "excluded": World([SQUARE], [ROAD, approach("excluded")]),
    "permissive": World([SQUARE], [ROAD, approach("permissive")]),
    "unknown": World([SQUARE], [ROAD, approach("unknown")]),
    "gap_1m": World([SQUARE], [ROAD, ([(5, -10), (5, -1)], "official", False)]),
    "coverage": World([SQUARE], [FAR], gap=True),
    "edge_road": World([SQUARE], [([(-20, 0), (50, 0)], "inferred", True, "1", "2")]),
    "blocked": World(
        [SQUARE],
        [([(-20, -10), (5, -10)], "inferred", True, "1", "2"), ([(5, -10), (5, -1)], "public", False, "2", "3"), ([(5, -1), (5, 5)], "public", False, "3", "4")],
        barriers=[("3", True, [(5, -1)])],
    ),
    "crossing": World([SQUARE], [ROAD, ([(5, -20), (5, 5)], "public", False, "3", "4")]),
    "bridge": grade_world("1:yes:no", False),
    "bridge_shadow": grade_world("1:yes:no", True),
    "tunnel": grade_world("-1:no:yes", False),
    "tunnel_shadow": grade_world("-1:no:yes", True),
    "beside_bridge": World(
        [SQUARE],
        [([(-20, 5), (50, 5)], "inferred", True, "1", "2", "1:yes:no"), ([(-20, -10), (5, -10)], "inferred", True, "3", "4"), ([(5, -10), (5, 5)], "public", False, "4", "5")],
    ),
    "public_wins": World([SQUARE], [ROAD, approach("permissive"), ([(6, -10), (6, 5)], "official", False)]),
    "permissive_gap": World([SQUARE], [ROAD, approach("permissive", -1)]),
    "permissive_barrier": World([SQUARE], [ROAD, approach("permissive")], barriers=[("3", True, [(5, 0)])]),
    "hint": World([SQUARE], [([(-20, -20), (50, -20)], "inferred", True, "1", "2")], hints=[("", "", box(0, -25, 10, 0))]),
    "private_hint": World([SQUARE], [([(-20, -20), (50, -20)], "inferred", True, "1", "2")], hints=[("", "private", box(0, -25, 10, 0))]),
    "triangle": World([[[(0.0, 0.0), (20.0, 0.0), (10.0, 20.0), (0.0, 0.0)]]], [ROAD, ([(10, -10), (10, 8)], "official", False)]),
    "diagonal": World([[[(0.0, 0.0), (20.0, 20.0), (0.0, 20.0), (0.0, 0.0)]]], [ROAD, ([(15, -10), (15, 12)], "official", False)]),
    "seam": World([box(19995, 0, 20005, 10)], [([(19900, -10), (20100, -10)], "inferred", True, "1", "2"), ([(20000, -10), (20000, 5)], "official", False)]),
}
EXPECTED = {
    "adjoining": ["access_evidenced", "likely_access_island"],
    "corner": ["uncertain", "uncertain"],
    "small": ["uncertain", "uncertain", "likely_access_island"],
    "tiny_access": ["access_evidenced"],
    "excluded": ["likely_access_island"],
    "permissive": ["permissive_access_evidenced"],
    "unknown": ["uncertain"],
    "gap_1m": ["uncertain"],
    "coverage": ["uncertain"],
    "edge_road": ["uncertain"],
    "blocked": ["uncertain"],
    "crossing": ["likely_access_island"],
    "bridge": ["uncertain"],
    "bridge_shadow": ["uncertain"],
    "tunnel": ["uncertain"],
    "tunnel_shadow": ["uncertain"],
    "beside_bridge": ["access_evidenced"],
    "public_wins": ["access_evidenced"],
    "permissive_gap": ["uncertain"],
    "permissive_barrier": ["uncertain"],
    "hint": ["uncertain"],
    "private_hint": ["uncertain"],
    "triangle": ["access_evidenced"],
    # The path ends 3/sqrt(2) m short of the sloping side: within 5 m but not within 2 m.
    "diagonal": ["uncertain"],
    "seam": ["access_evidenced"],
}
REASONS = {
    "gap_1m": "tolerance_sensitive",
    "coverage": "official_coverage_missing",
    "edge_road": "boundary_contact_without_entrance",
    "blocked": "mapped_barrier_at_contact",
    "bridge": "possible_grade_separation_at_contact",
    "bridge_shadow": "possible_grade_separation_at_contact",
    "tunnel": "possible_grade_separation_at_contact",
    "tunnel_shadow": "possible_grade_separation_at_contact",
    "hint": "unverified_osm_common_nearby",
    "private_hint": "unverified_osm_common_nearby",
    "corner": "uncertain_land_connection",
    "tiny_access": "very_small_site_geometry",
    "diagonal": "tolerance_sensitive",
    "crossing": "no_evidenced_network_connection",
}


@pytest.fixture(scope="module")
def outcome(spark):
    return run(spark, WORLDS)


@pytest.mark.parametrize("name", list(WORLDS))
def test_status(outcome, name):
    assert [r["status"] for r in outcome[name]] == EXPECTED[name]
    if name in REASONS:
        assert REASONS[name] in outcome[name][0]["reasons"].split(";")


def test_details(outcome):
    assert outcome["adjoining"][0]["parcel_count"] == 2
    assert outcome["hint"][0]["default_access"] is False
    assert "only_weak_or_permissive_connection" in outcome["hint"][0]["reasons"]
    assert "only_weak_or_permissive_connection" not in outcome["private_hint"][0]["reasons"]
    assert outcome["triangle"][0]["area_ha"] == pytest.approx(0.02)


def test_reachability_grows_with_tolerance_and_permission(outcome):
    for rows in outcome.values():
        for r in rows:
            assert r["exact_access"] <= r["default_access"] <= r["relaxed_access"]
            for n in ("exact", "default", "relaxed"):
                assert r[f"{n}_access"] <= r[f"{n}_permissive_access"]


def test_tile_size_does_not_change_the_result(spark, outcome):
    chosen = {n: WORLDS[n] for n in ("adjoining", "beside_bridge", "triangle", "seam")}
    key = lambda rows: [(r["status"], r["reasons"], r["nearest_mapped_route_m"]) for r in rows]
    again = run(spark, chosen, tile_size_m=100.0)
    assert {n: key(r) for n, r in again.items()} == {n: key(outcome[n]) for n in chosen}


def test_threshold_zero_promotes_small_sites(spark):
    rows = run(spark, {"small": WORLDS["small"]}, min_candidate_area_m2=0.0)["small"]
    assert {r["status"] for r in rows} == {"likely_access_island"}


def test_settings_are_checked():
    from strollgraph.plans.analyse import Settings

    for bad in ({"tolerance_m": -1}, {"tile_size_m": 50}, {"min_candidate_area_m2": float("nan")}, {"min_candidate_area_m2": -1}):
        with pytest.raises(ValueError):
            Settings(**bad)
