"""Connected components and reachability by repeated graph contraction.

Each round every node picks the neighbour (or itself) with the smallest hash, and edges are rewritten between
the picks; loops and repeats vanish, so the edge table shrinks by a constant factor per round
(randomised contraction, Boegeholz, Brand and Todor 2020).  Picks are composed back at the end.
All steps are partial aggregates and equi-joins, so a hub holding a large share of the edges is
pre-aggregated before the shuffle and its join partition can be split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strollgraph.session import cut

MAX_ROUNDS = 200


def connected_components(
    edges: DataFrame, a: str = "a", b: str = "b", keys: list[str] | None = None, smallest: bool = True
) -> DataFrame:
    """Component of every node that has an edge: ``keys + [node, root]``.

    ``keys`` separates independent graphs held in one table (for example tolerance variants).
    With ``smallest`` the root is the least node of the component, otherwise any member.
    """
    keys = list(keys or [])
    current = cut(
        edges.where(F.col(a) != F.col(b))
        .select(*keys, F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
        .distinct()
    )
    picks: list[DataFrame] = []
    for round_no in range(MAX_ROUNDS):
        if current.isEmpty():
            break
        score = lambda c: F.struct(F.xxhash64(F.lit(round_no), F.col(c)).alias("h"), F.col(c).alias("n"))
        both = current.select(*keys, F.col("u").alias("node"), score("v").alias("other")).unionByName(
            current.select(*keys, F.col("v").alias("node"), score("u").alias("other"))
        )
        best = both.groupBy(*keys, "node").agg(F.min("other").alias("other"))
        pick = cut(
            best.select(*keys, "node", F.least("other", score("node"))["n"].alias("pick"))
        )
        picks.append(pick)
        moved = (
            current.join(pick.withColumnsRenamed({"node": "u", "pick": "pu"}), [*keys, "u"])
            .join(pick.withColumnsRenamed({"node": "v", "pick": "pv"}), [*keys, "v"])
            .where(F.col("pu") != F.col("pv"))
        )
        current = cut(
            moved.select(*keys, F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct()
        )
    else:
        raise RuntimeError(f"Components did not settle within {MAX_ROUNDS} rounds")
    if not picks:
        return current.select(*keys, F.col("u").alias("node"), F.col("v").alias("root"))
    roots = picks[-1].select(*keys, "node", F.col("pick").alias("root"))
    for pick in reversed(picks[:-1]):
        roots = pick.join(
            roots.withColumnsRenamed({"node": "pick"}), [*keys, "pick"], "left"
        ).select(*keys, "node", F.coalesce("root", "pick").alias("root"))
    if not smallest:
        return cut(roots)
    roots = cut(roots)
    least = roots.groupBy(*keys, "root").agg(F.min("node").alias("least"))
    return roots.join(least, [*keys, "root"]).select(*keys, "node", F.col("least").alias("root"))


def reachable(roots: DataFrame, seeds: DataFrame, keys: list[str]) -> DataFrame:
    """Nodes whose component holds a seed.  ``seeds`` has ``keys + [node]``.

    A seed without any edge reaches only itself, so it never marks a site.
    """
    seeded = roots.join(seeds, [*keys, "node"], "left_semi").select(*keys, "root").distinct()
    return roots.join(seeded, [*keys, "root"], "left_semi").select(*keys, "node")
