"""Edges that all variants share are contracted once, and the components stay those of every variant alone."""

import random

from strollgraph.operators import classify as K
from strollgraph.operators.components import connected_components


def world(spark):
    dice = random.Random(3)
    tiers = ["official", "inferred", "permissive", "unknown", "excluded", "site"]
    kinds = [(f"n{i}", dice.choice(tiers)) for i in range(60)]
    edges = [(f"n{dice.randrange(60)}", f"n{dice.randrange(60)}", dice.choice([0.0, 0.0, 1.0, 4.0]), dice.random() < 0.2) for _ in range(80)]
    return spark.createDataFrame(edges, "a string, b string, distance double, weak boolean"), spark.createDataFrame(kinds, "node string, kind string")


def groups(rows):
    found = {}
    for r in rows:
        found.setdefault((r.variant, r.root), set()).add(r.node)
    return sorted((variant, sorted(nodes)) for (variant, _root), nodes in found.items())


def test_components_of_variants(spark, monkeypatch):
    edges, kinds = world(spark)
    chosen = K.variants(2.0)
    every = K.variant_edges(edges, kinds, chosen).where("a <> b")
    want = groups(connected_components(every, keys=["variant"]).collect())
    runs = []

    def counted(df, keys=None, **more):
        runs.append(df.count())
        return connected_components(df, keys=keys, **more)

    monkeypatch.setattr(K, "connected_components", counted)
    assert groups(K.variant_roots(edges, kinds, chosen).collect()) == want and len(want) > len(chosen)
    assert len(runs) == 2 and 0 < runs[0] and sum(runs) < every.count()


def test_one_variant_alone_and_no_shared_edges(spark, monkeypatch):
    edges, kinds = world(spark)
    for chosen in ([v for v in K.variants(2.0) if v.weak], [K.Variant("none", -1.0, ("official",)), K.variants(2.0)[0]]):
        want = groups(connected_components(K.variant_edges(edges, kinds, chosen).where("a <> b"), keys=["variant"]).collect())
        assert groups(K.variant_roots(edges, kinds, chosen).collect()) == want and want


def test_roots_of_the_asked_nodes(spark):
    edges, kinds = world(spark)
    chosen = K.variants(2.0)
    rows = lambda df: [r for r in df.collect() if int(r.node[1:]) % 3 == 0]
    only = kinds.where("cast(substr(node, 2) as int) % 3 = 0")
    got, want = K.variant_roots(edges, kinds, chosen, only).collect(), rows(K.variant_roots(edges, kinds, chosen))
    assert groups(got) == groups(want) and got and all(int(r.node[1:]) % 3 == 0 for r in got)


def test_snap_links_are_measured_once(spark):
    from strollgraph.functions import geometry as G
    from strollgraph.operators import network as N

    paths = [(0, "official", [(0.0, 0.0), (50.0, 0.0)]), (1, "public", [(53.0, 0.0), (90.0, 0.0)])]
    routes = spark.createDataFrame(paths, f"route_index long, tier string, path {G.PATH}").selectExpr("*", "'0:no:no' as grade")
    gate = spark.createDataFrame([("n", True, [(51.0, 0.0)])], f"node_id string, blocking boolean, path {G.PATH}")
    edges = N.snap_edges(routes, gate, 5.0)
    assert [tuple(r) for r in edges.collect()] == [("route:0", "route:1", 3.0, True)]
    assert all("/stage-" in f for f in edges.inputFiles()) and edges.inputFiles()
