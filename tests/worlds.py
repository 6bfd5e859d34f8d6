"""Small literal worlds; several are laid side by side so that one run answers them all."""

from dataclasses import dataclass, field

from strollgraph.functions.geometry import PATH, RINGS
from strollgraph.operators import sites as D
from strollgraph.plans import analyse as A

STEP = 60000  # a multiple of the tile size keeps the seams of every world in place


def box(x0, y0, x1, y1):
    return [[(float(x), float(y)) for x, y in [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]]


@dataclass
class World:
    land: list
    routes: list
    barriers: list = field(default_factory=list)
    hints: list = field(default_factory=list)
    gap: bool = False


ROAD = ([(-20, -10), (50, -10)], "inferred", True, "1", "2")


def shifted(points, dx):
    return [(float(x + dx), float(y)) for x, y in points]


def build(spark, worlds):
    """Inputs of a run; the land of world ``k`` lies around ``x = k * STEP``."""
    land, routes, barriers, hints, gaps = [], [], [], [], []
    for k, (name, w) in enumerate(worlds.items()):
        dx = k * STEP
        for i, rings in enumerate(w.land):
            cid = f"{name}:{i}"
            land.append((cid, cid, "", "{}", [shifted(r, dx) for r in rings]))
        for points, tier, seed, *rest in w.routes:
            nodes = [f"osm:{name}-{n}" if n else "" for n in (rest[:2] or ["", ""])]
            grade = rest[2] if len(rest) > 2 else "0:no:no"
            routes.append((len(routes), f"route:{len(routes)}", tier, seed, *nodes, grade, shifted(points, dx)))
        for node, blocking, points in w.barriers:
            barriers.append((f"{name}-{node}", blocking, shifted(points, dx)))
        for i, (foot, access, rings) in enumerate(w.hints):
            hints.append((f"hint:{name}{i}", f"{name}{i}", foot, access, [shifted(r, dx) for r in rings]))
        if w.gap:
            gaps.append((name, name, [shifted(r, dx) for r in box(-1000, -1000, 2000, 2000)]))
    frame = spark.createDataFrame
    land_df = frame(land, f"component_id string, source_id string, name string, source_attributes string, rings {RINGS}")
    route_df = frame(
        routes,
        "route_index bigint, source_id string, tier string, seed boolean, start_node string, end_node string, "
        f"grade string, path {PATH}",
    )
    return A.Inputs(
        catalogue=D.form_sites(land_df), routes=route_df,
        barriers=frame(barriers, f"node_id string, blocking boolean, path {PATH}"),
        gaps=frame(gaps, f"code string, name string, rings {RINGS}"),
        hints=frame(hints, f"site_id string, source_id string, foot string, access string, rings {RINGS}"),
    )


def run(spark, worlds, **settings):
    """Rows of the run per world name, ordered by easting."""
    result = A.analyse(build(spark, worlds), A.Settings(**settings))
    found = {name: [] for name in worlds}
    names = list(worlds)
    for row in sorted(result.sites.collect(), key=lambda r: r["easting"]):
        found[names[int((row["easting"] + STEP / 2) // STEP)]].append(row)
    return found
