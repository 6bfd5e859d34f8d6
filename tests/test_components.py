import random

import pytest
from pyspark.errors import AnalysisException

from strollgraph.operators.components import connected_components


def brute(edges):
    parent = {}

    def find(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in parent}


def test_random_graphs_chains_and_a_hub(spark):
    rng = random.Random(1)
    graphs = {
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "chain": [(i, i + 1) for i in range(400)],
        "hub": [(0, i) for i in range(1, 500)],
        "none": [],
    }
    rows = [(g, a, b) for g, edges in graphs.items() for a, b in edges]
    got = connected_components(spark.createDataFrame(rows, "g string, a int, b int"), keys=["g"]).collect()
    found = {(r["g"], r["node"]): r["root"] for r in got}
    want = {(g, n): r for g, edges in graphs.items() for n, r in brute([(a, b) for a, b in edges if a != b]).items()}
    assert found == want


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string")).collect() == []


def test_stage_tables_can_be_dropped(spark, monkeypatch):
    from strollgraph import session

    monkeypatch.setattr(session, "_STAGES", [])
    first, second = session.cut(spark.range(3)), session.cut(spark.range(4))
    assert first.count() + second.count() == 7
    folder = session._STAGES[0]
    assert session.drop_stages(spark) == 2 and session.drop_stages(spark) == 0
    with pytest.raises(AnalysisException):
        spark.read.parquet(folder)
