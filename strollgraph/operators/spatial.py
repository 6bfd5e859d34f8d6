"""Tile-keyed spatial joins.

Every spatial join is an equi-join on grid cells with a bounding-box residual, so Spark plans it
as a hash or sort-merge join and AQE can split a hot cell.  A pair that meets in several cells is
kept only in the cell of its reference corner, which removes duplicates without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strollgraph.functions import geometry as G
from strollgraph.functions import kernels as M
from strollgraph.session import cut as store

BOUNDS = ("xmin", "ymin", "xmax", "ymax")
DEFAULT_CELL_M = 250.0
# Polygons are cut along the lines of this grid before they are joined.
PIECE_CELL_M = 20000.0
# Those of more edges than this are cut along a finer one, edge by edge.
FEW_EDGES = 64
EDGE_CELL_M = 250.0


def within_bbox(df: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows whose bounds meet the closed box; plain comparisons, so Parquet statistics apply."""
    west, south, east, north = (float(v) for v in box)
    return df.where(
        (F.col("xmin") <= east) & (F.col("xmax") >= west) & (F.col("ymin") <= north) & (F.col("ymax") >= south)
    )


def whole_polygons(polygons: DataFrame) -> DataFrame:
    """Add marked ``edges`` and bounds of every polygon."""
    return G.with_bounds(
        polygons.withColumn("edges", F.expr(G.marked(G.polygon_edges("rings")))), "flatten(rings)"
    )


def _whole() -> Column:
    """Area, lower left corner and a point inside of ``edges``."""
    return F.struct(
        F.expr(f"round({G.signed_area('edges')}, 6)").alias("area"), F.col("xmin"), F.col("ymin"),
        F.expr(G.inner_point("edges", "xmin", "ymin", "xmax", "ymax")).alias("inner"),
    )


def polygon_wholes(polygons: DataFrame) -> DataFrame:
    """Only ``whole`` of ``polygon_pieces``, one row per polygon: nothing is cut or stored."""
    kept = [c for c in polygons.columns if c != "rings"]
    return whole_polygons(polygons).select(*kept, _whole().alias("whole"))


def polygon_pieces(polygons: DataFrame, cell: float = PIECE_CELL_M, edge_cell: float = EDGE_CELL_M) -> DataFrame:
    """Add marked ``edges`` and bounds, one row per grid cell that the polygon meets.

    Polygons of few edges are cut along the lines of ``cell`` in place.  Those with more than ``FEW_EDGES`` are cut edge by edge along
    ``edge_cell``, so that no row holds more than the edges of one small cell.  Cutting shows nowhere but in the number of rows.
    ``whole`` holds the area, the lower left corner and a point inside of the uncut polygon.
    """
    fits = lambda size: " and ".join(f"{G.tile_index(f'{a}min', size)} = {G.tile_index(f'{a}max', size)}" for a in ("x", "y"))
    # Few bytes make much work here and in what follows, so the rows of a small file are dealt to all cores first.  The kernels of a whole
    # polygon run once: its edges become a table, where the three ways below and every reader after them only filter.
    bounded = store(whole_polygons(polygons.repartition(F.xxhash64("rings"))).withColumns({
        "whole": _whole(),
        "_many": F.expr(f"size(edges) > {FEW_EDGES} and not ({fits(edge_cell)})"),
        "_one": F.expr(fits(cell)),
    }))
    light = bounded.where("not _many").drop("_many")
    window = (f"_cx * {cell}D", f"_cy * {cell}D", f"(_cx + 1) * {cell}D", f"(_cy + 1) * {cell}D")
    cut = (
        light.where("not _one").drop("_one")
        .withColumn("_cx", F.expr(f"explode({G.tile_range('xmin', 'xmax', cell)})"))
        .withColumn("_cy", F.expr(f"explode({G.tile_range('ymin', 'ymax', cell)})"))
        .withColumn("edges", G.keep(
            G.clip_outline("rings", *window), "pe", f"exists(pe, e -> not e.drawn) or abs({G.signed_area('pe')}) > 1e-9D"
        ))
        .drop("_cx", "_cy")
    )
    # Equal rings are cut once; two hashes stand for them.
    shape = {"_ha": F.xxhash64("rings"), "_hb": F.xxhash64(F.lit(1), "rings")}
    heavy = bounded.where("_many").drop("_many", "_one").withColumns(shape)
    shapes = heavy.groupBy(*shape).agg(F.first("rings").alias("rings"))
    cells = edge_cells(shapes.select(*shape, F.expr(f"explode({G.polygon_edges('rings')})").alias("e")), list(shape), edge_cell)
    dealt = heavy.drop("edges", "rings", *BOUNDS).join(cells, list(shape)).drop(*shape)
    ends = "flatten(transform(edges, be -> array(named_struct('x', be.x0, 'y', be.y0), named_struct('x', be.x1, 'y', be.y1))))"
    return light.where("_one").drop("_one").unionByName(G.with_bounds(cut, ends)).drop("rings").unionByName(G.with_bounds(dealt, ends))


def _on_line(axis: str, line: str) -> str:
    """The other coordinate where edge ``e`` crosses a line of ``axis``, exact at its ends."""
    other = "y" if axis == "x" else "x"
    at = f"e.{other}0 + (({line}) - e.{axis}0) / (e.{axis}1 - e.{axis}0) * (e.{other}1 - e.{other}0)"
    return f"case when e.{axis}0 = ({line}) then e.{other}0 when e.{axis}1 = ({line}) then e.{other}1 else {at} end"


def _lines(axis: str, g: str, closed: bool) -> str:
    """Numbers of the grid lines that edge ``e`` crosses, those through its ends included if ``closed``."""
    low, high = f"least(e.{axis}0, e.{axis}1) / {g}", f"greatest(e.{axis}0, e.{axis}1) / {g}"
    first, last = (f"ceil({low})", f"floor({high})") if closed else (f"floor({low}) + 1", f"ceil({high}) - 1")
    return f"if(e.{axis}0 <> e.{axis}1 and {first} <= {last}, sequence(cast({first} as bigint), cast({last} as bigint)), cast(array() as array<bigint>))"


def cell_parts(edges: DataFrame, cell: float) -> DataFrame:
    """Edges ``e`` cut at grid lines: all columns, the part ``s`` and its cell ``_cx, _cy``; a part along a line lies in the cell on its left."""
    g = f"{float(cell)}D"

    def cuts(axis: str) -> str:
        line = f"(k * {g})"
        x, y = (line, _on_line(axis, line)) if axis == "x" else (_on_line(axis, line), line)
        return f"transform({_lines(axis, g, False)}, k -> named_struct('t', ({line} - e.{axis}0) / (e.{axis}1 - e.{axis}0), 'x', {x}, 'y', {y}))"

    points = (
        f"concat(array(named_struct('t', 0D, 'x', e.x0, 'y', e.y0)), array_sort(concat({cuts('x')}, {cuts('y')})), "
        "array(named_struct('t', 1D, 'x', e.x1, 'y', e.y1)))"
    )
    pair = "(p, q) -> named_struct('x0', p.x, 'y0', p.y, 'x1', q.x, 'y1', q.y)"
    parts = G.let(points, "ps", f"filter(zip_with(slice(ps, 1, size(ps) - 1), slice(ps, 2, size(ps) - 1), {pair}), p -> p.x0 <> p.x1 or p.y0 <> p.y1)")

    def home(axis: str, before: str) -> str:
        middle = f"((s.{axis}0 + s.{axis}1) / 2D / {g})"
        return f"cast(floor({middle}) - if(s.{axis}0 = s.{axis}1 and floor({middle}) = {middle} and {before}, 1, 0) as bigint)"

    return edges.withColumn("s", F.expr(f"explode({parts})")).withColumns(
        {"_cx": F.expr(home("x", "s.y1 > s.y0")), "_cy": F.expr(home("y", "s.x1 < s.x0"))}
    )


def cell_segments(segments: DataFrame, cell: float) -> DataFrame:
    """Segments ``s``, whole, once for every grid cell that they run in: ``s, _cx, _cy``; a point lies in one cell."""
    point = "s.x0 = s.x1 and s.y0 = s.y1"
    runs = cell_parts(segments.where(f"not ({point})").select(F.col("s").alias("e")), cell).select(F.col("e").alias("s"), "_cx", "_cy").distinct()
    still = segments.where(point).select("s", F.expr(G.tile_index("s.x0", cell)).alias("_cx"), F.expr(G.tile_index("s.y0", cell)).alias("_cy"))
    return runs.unionByName(still.distinct())


def edge_cells(edges: DataFrame, key: list[str], cell: float = EDGE_CELL_M) -> DataFrame:
    """``key, edges`` for every grid cell that polygons given by their oriented edges ``e`` meet: the polygon part in the cell, closed by drawn edges.

    Edges are cut at grid lines and dealt to the cell they run in (along a line, to the one on their inner side).  Where a grid line runs inside a
    polygon follows from the edges that cross it: in the order of their places each one changes whether the polygon lies just above and
    just below the line, and where it lies on both sides the line is drawn for both cells.  So rows follow the edges and the cells
    within, and no polygon is ever held as a whole.
    """
    g = f"{float(cell)}D"
    real = cell_parts(edges, cell).select(
        *key, "_cx", "_cy", F.expr("named_struct('x0', s.x0, 'y0', s.y0, 'x1', s.x1, 'y1', s.y1, 'drawn', false)").alias("edge")
    )
    met = lambda axis: (
        f"transform({_lines(axis, g, True)}, k -> named_struct('axis', '{axis}', 'line', k, 'at', {_on_line(axis, f'(k * {g})')}, "
        + ", ".join(f"'{name}', cast((e.{axis}0 {sign} k * {g}) <> (e.{axis}1 {sign} k * {g}) as int)" for name, sign in (("above", ">"), ("below", ">="))) + "))"
    )
    events = edges.select(*key, F.expr(f"inline(concat({met('x')}, {met('y')}))"))
    order = Window.partitionBy(*key, "axis", "line").orderBy("at")
    inner = events.select(
        *key, "axis", "line", F.col("at").alias("low"), F.lead("at").over(order).alias("high"),
        F.sum("above").over(order).alias("above"), F.sum("below").over(order).alias("below"),
    ).where("above % 2 = 1 and below % 2 = 1 and high > low")
    stretches = inner.withColumn("c", F.expr(f"explode(sequence(cast(floor(low / {g}) as bigint), cast(ceil(high / {g}) - 1 as bigint)))")).select(
        *key, "axis", "line", "c", F.expr(f"greatest(low, c * {g})").alias("low"), F.expr(f"least(high, (c + 1) * {g})").alias("high")
    ).where("low < high")

    def rim(cx: str, cy: str, x0: str, y0: str, x1: str, y1: str) -> str:
        return f"named_struct('_cx', {cx}, '_cy', {cy}, 'edge', named_struct('x0', {x0}, 'y0', {y0}, 'x1', {x1}, 'y1', {y1}, 'drawn', true))"

    at = f"line * {g}"
    level = f"array({rim('c', 'line', 'low', at, 'high', at)}, {rim('c', 'line - 1', 'high', at, 'low', at)})"
    upright = f"array({rim('line', 'c', at, 'high', at, 'low')}, {rim('line - 1', 'c', at, 'low', at, 'high')})"
    drawn = stretches.select(*key, F.expr(f"inline(if(axis = 'y', {level}, {upright}))"))
    return real.unionByName(drawn).groupBy(*key, "_cx", "_cy").agg(F.collect_list("edge").alias("edges")).drop("_cx", "_cy")


def outline_segments(polygons: DataFrame, keep: list[str]) -> DataFrame:
    """One row per oriented outline edge of marked ``edges``: kept columns, ``edge_no``, ``s`` and bounds."""
    edges = polygons.select(*keep, F.expr(f"posexplode({G.outline_edges('edges')}) as (edge_no, s)"))
    return segment_bounds(edges)


def path_segments(lines: DataFrame, keep: list[str]) -> DataFrame:
    """One row per line segment: kept columns, ``edge_no``, ``s`` and bounds."""
    return segment_bounds(lines.select(*keep, F.expr(f"posexplode({G.path_edges('path')}) as (edge_no, s)")))


def segment_bounds(df: DataFrame, s: str = "s") -> DataFrame:
    return df.selectExpr(
        "*",
        f"least({s}.x0, {s}.x1) as xmin", f"least({s}.y0, {s}.y1) as ymin",
        f"greatest({s}.x0, {s}.x1) as xmax", f"greatest({s}.y0, {s}.y1) as ymax",
    )


def near_pairs(
    left: DataFrame,
    right: DataFrame,
    distance: float = 0.0,
    cell: float = DEFAULT_CELL_M,
    condition: Column | None = None,
) -> DataFrame:
    """Pairs whose bounding boxes come within ``distance``; columns get prefixes ``a_`` and ``b_``."""
    pad = float(distance)
    a = left.select([F.col(c).alias(f"a_{c}") for c in left.columns])
    b = right.select([F.col(c).alias(f"b_{c}") for c in right.columns])
    for axis in ("x", "y"):
        a = a.withColumn(
            f"_c{axis}", F.expr(f"explode({G.tile_range(f'a_{axis}min - {pad}D', f'a_{axis}max + {pad}D', cell)})")
        )
        b = b.withColumn(f"_c{axis}", F.expr(f"explode({G.tile_range(f'b_{axis}min', f'b_{axis}max', cell)})"))
    meets = " and ".join(
        f"a_{axis}min - {pad}D <= b_{axis}max and a_{axis}max + {pad}D >= b_{axis}min" for axis in ("x", "y")
    )
    # The lower-left corner of the common box lies in exactly one cell that both sides occupy.
    once = " and ".join(
        f"{G.tile_index(f'greatest(a_{axis}min - {pad}D, b_{axis}min)', cell)} = _c{axis}" for axis in ("x", "y")
    )
    # Dealt by cell even if the other side is broadcast: what follows costs by the pair, and a small file is one task.  The other side is dealt
    # too, so that its size is known once it is spread over cells: the planner knows its file, of which a few MB can become GB in a broadcast.
    joined = a.repartition("_cx", "_cy").join(b.repartition("_cx", "_cy"), ["_cx", "_cy"]).where(f"{meets} and {once}")
    if condition is not None:
        joined = joined.where(condition)
    return joined.drop("_cx", "_cy")


def covered_spans(
    segments: DataFrame,
    polygons: DataFrame,
    cell: float = DEFAULT_CELL_M,
    condition: Column | None = None,
) -> DataFrame:
    """Stretches of segments whose left or right side lies in a polygon.

    Result: all prefixed input columns except the polygon edges, plus ``is_left``, ``t0``, ``t1``.
    """
    return M.cover_rows(near_pairs(segments, polygons, 0.0, cell, condition), "a_s", "b_edges")


def explode_spans(pairs: DataFrame) -> DataFrame:
    """Explode the ``left`` and ``right`` lists of ``with_cover`` into rows."""

    tagged = ", ".join(
        f"transform({name}, p -> named_struct('is_left', {flag}, 't0', p.t0, 't1', p.t1))"
        for name, flag in (("left", "true"), ("right", "false"))
    )
    return pairs.withColumn("_p", F.expr(f"explode(concat({tagged}))")).select(
        *[c for c in pairs.columns if c not in ("left", "right")], "_p.is_left", "_p.t0", "_p.t1"
    )


def union_measures(spans: DataFrame, group: list[str], flags: dict[str, Column]) -> DataFrame:
    """Measure of the union of the flagged stretches per group and flag.

    Ordered by start, a stretch adds only what lies beyond the furthest earlier end, so a running
    maximum is enough and nothing is collected.
    """
    marked = spans.withColumns({f"_f_{k}": v for k, v in flags.items()})
    before = Window.partitionBy(*group).orderBy("t0", "t1").rowsBetween(Window.unboundedPreceding, -1)
    added = marked.withColumns(
        {f"_m_{k}": F.max(F.when(F.col(f"_f_{k}"), F.col("t1"))).over(before) for k in flags}
    ).withColumns(
        {
            f"_d_{k}": F.when(
                F.col(f"_f_{k}"),
                F.greatest(
                    F.lit(0.0), F.col("t1") - F.greatest(F.col("t0"), F.coalesce(F.col(f"_m_{k}"), F.lit(0.0)))
                ),
            ).otherwise(0.0)
            for k in flags
        }
    )
    return added.groupBy(*group).agg(*[F.sum(f"_d_{k}").alias(k) for k in flags])


def uncovered_spans(spans: DataFrame, segments: DataFrame, key: list[str]) -> DataFrame:
    """Stretches of every segment left free by its spans: the segment columns plus ``t0``, ``t1``.

    ``spans`` holds ``key``, ``t0``, ``t1``.  Segments without spans come back whole.
    """
    # A zero-length marker at 1 closes the last gap; a start marker keeps untouched segments.
    columns = [c for c in segments.columns if c not in key]
    packed = segments.select(*key, F.struct(*columns).alias("_seg"), F.lit(1.0).alias("t0"), F.lit(1.0).alias("t1"))
    marks = packed.unionByName(spans.select(*key, "t0", "t1"), allowMissingColumns=True)
    order = Window.partitionBy(*key).orderBy("t0", "t1")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*key)
    gaps = marks.select(
        *key,
        F.max("_seg").over(whole).alias("_seg"),
        F.coalesce(F.max("t1").over(before), F.lit(0.0)).alias("_from"),
        F.col("t0").alias("_to"),
    ).where(F.col("_to") - F.col("_from") > 1e-12)
    return gaps.select(*key, "_seg.*", F.col("_from").alias("t0"), F.col("_to").alias("t1"))


def overlap_areas(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    cell: float = DEFAULT_CELL_M,
    left_outline: DataFrame | None = None,
) -> DataFrame:
    """Overlap area of every pair of shapes with a positive overlap.

    Green's formula along the outline of the intersection: the parts of left edges whose inner
    side lies in the right shape, and the parts of right edges strictly inside the left one.
    Inputs are piece tables (``polygon_pieces``).  When pieces of one left key overlap each other
    (the components of a site), pass the outline of their union (``key``, ``s``, bounds).
    """
    left_edges = (
        outline_segments(left, [left_key]).drop("edge_no") if left_outline is None else left_outline
    ).select(F.col(left_key).alias("k"), "s", *BOUNDS)
    right_edges = outline_segments(right, [right_key]).select(F.col(right_key).alias("k"), "s", *BOUNDS)

    def parts(segments: DataFrame, shapes: DataFrame, key: str, strictly_inside: bool) -> DataFrame:
        spans = covered_spans(segments, shapes.select(F.col(key).alias("k"), "edges", *BOUNDS), cell)
        spans = spans.select("a_k", "a_s", "b_k", "is_left", "t0", "t1")
        flags = {"l": F.col("is_left")}
        if strictly_inside:
            flags |= {"r": ~F.col("is_left"), "u": F.lit(True)}
        share = F.col("l") + F.col("r") - F.col("u") if strictly_inside else F.col("l")
        return union_measures(spans, ["a_k", "a_s", "b_k"], flags).select(
            "a_k", "b_k", (F.expr(G.edge_cross("a_s")) * share).alias("part")
        )

    forward = parts(left_edges, right, right_key, False)
    backward = parts(right_edges, left, left_key, True).select(
        F.col("b_k").alias("a_k"), F.col("a_k").alias("b_k"), "part"
    )
    return (
        forward.unionByName(backward)
        .groupBy("a_k", "b_k")
        .agg((F.sum("part") / 2).alias("overlap_m2"))
        .where(F.col("overlap_m2") > 1e-6)
        .select(F.col("a_k").alias(left_key), F.col("b_k").alias(right_key), "overlap_m2")
    )


def link_distance(df: DataFrame, distance: float) -> DataFrame:
    """Add ``left``, ``right`` (cover of ``a_s`` by ``b_edges``) and ``link``, its shortest connection.

    Rows further apart than ``distance`` are dropped, and so are the edges.  ``link.d2`` is 0 when the segment meets the shape.
    """
    return M.links_within(df, "a_s", "b_edges", distance)


def segment_links(
    left: DataFrame, right: DataFrame, distance: float, cell: float = DEFAULT_CELL_M, condition: Column | None = None
) -> DataFrame:
    """Pairs of plain segments (``s`` on both sides) within ``distance`` with their shortest ``link``."""
    pairs = near_pairs(left, right, distance, cell, condition)
    limit = float(distance) ** 2
    return pairs.withColumn("link", G.keep(G.nearest_link("a_s", "array(b_s)"), "k", f"k.d2 <= {limit}D"))
