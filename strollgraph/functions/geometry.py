"""Planar geometry as Spark SQL expressions.

A polygon is ``rings``: array of closed rings of ``struct<x,y>``, outer ring first, then holes.
A line is ``path``: array of ``struct<x,y>``.  Both are used through flat edge arrays
``array<struct<x0,y0,x1,y1>>``; polygon edges are oriented so that the interior lies on the left.
Where a polygon was cut to a window, ``drawn`` marks the edges that the cut has added: they close
the piece for crossings and areas and are no part of the outline.

Every overlay measure is taken along an edge.  ``crossings`` intersects the line carrying a
segment with a polygon, once displaced infinitely little to the left and once to the right; the
sorted crossing positions pair up into the stretches whose left (right) side lies in the polygon.
Lengths inside a polygon, lengths along its boundary, overlap areas and union areas (by Green's
formula over the oriented edges) all follow from the measures of those stretches.

The functions map SQL text to SQL text: a kernel reaches the JVM as one parsed expression, which
keeps plans quick to build.  Arguments are column names or SQL expressions; wrap results in
``F.expr``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
PATH = f"array<{POINT}>"
RINGS = f"array<{PATH}>"
EDGES = "array<struct<x0:double,y0:double,x1:double,y1:double>>"
SPANS = "array<struct<t0:double,t1:double>>"

# Perpendicular offset in metres below which a vertex counts as lying on the other line.
ON_LINE_M = 1e-7


def let(value: str, name: str, body: str) -> str:
    """Evaluate ``value`` once for a body that needs it several times."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def keep(value: str, name: str, test: str) -> Column:
    """Generator giving ``value`` where ``test`` holds and no row otherwise.

    A filter on a computed column would be pushed below it and evaluate the expression twice.
    """
    return F.expr(f"explode(filter(array({value}), {name} -> {test}))")


def point(x: str, y: str) -> str:
    return f"named_struct('x', cast({x} as double), 'y', cast({y} as double))"


def segment(x0: str, y0: str, x1: str, y1: str) -> str:
    return (
        f"named_struct('x0', cast({x0} as double), 'y0', cast({y0} as double), "
        f"'x1', cast({x1} as double), 'y1', cast({y1} as double))"
    )


def box_rings(x0: str, y0: str, x1: str, y1: str) -> str:
    """Axis-aligned rectangle as one counter-clockwise ring."""
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return "array(array(" + ", ".join(point(x, y) for x, y in corners) + "))"


def line_path(x0: str, y0: str, x1: str, y1: str) -> str:
    return f"array({point(x0, y0)}, {point(x1, y1)})"


def path_edges(path: str) -> str:
    """Consecutive vertex pairs of a path."""
    pair = "(a, b) -> named_struct('x0', a.x, 'y0', a.y, 'x1', b.x, 'y1', b.y)"
    zipped = f"zip_with(slice(pp, 1, size(pp) - 1), slice(pp, 2, size(pp) - 1), {pair})"
    return let(path, "pp", f"if(size(pp) >= 2, {zipped}, cast(array() as {EDGES}))")


def edge_cross(e: str) -> str:
    return f"({e}.x0 * {e}.y1 - {e}.x1 * {e}.y0)"


def edge_length(e: str) -> str:
    return f"hypot({e}.x1 - {e}.x0, {e}.y1 - {e}.y0)"


def signed_area(edges: str) -> str:
    """Shoelace area; positive when the interior is on the left."""
    return f"(aggregate({edges}, 0D, (acc, ed) -> acc + {edge_cross('ed')}) / 2D)"


def ring_edges(rings: str) -> str:
    """Edges of every ring with the polygon interior on their left; repeated vertices make no edge."""
    real = f"filter({path_edges('ring')}, fe -> fe.x0 <> fe.x1 or fe.y0 <> fe.y1)"
    back = "transform(reverse(fw), fe -> named_struct('x0', fe.x1, 'y0', fe.y1, 'x1', fe.x0, 'y1', fe.y0))"
    turned = f"if(({signed_area('fw')} >= 0) = (ring_no = 0), fw, {back})"
    return f"transform({rings}, (ring, ring_no) -> {let(real, 'fw', turned)})"


def polygon_edges(rings: str) -> str:
    """All ring edges with the polygon interior on the left of each."""
    return f"flatten({ring_edges(rings)})"


def marked(edges: str, drawn: str = "false") -> str:
    """Edges with the mark ``drawn``."""
    return f"transform({edges}, me -> named_struct('x0', me.x0, 'y0', me.y0, 'x1', me.x1, 'y1', me.y1, 'drawn', {drawn}))"


def outline_edges(edges: str) -> str:
    """The edges of marked ``edges`` that belong to the outline, without the mark."""
    return (
        f"transform(filter({edges}, oe -> not oe.drawn), "
        "oe -> named_struct('x0', oe.x0, 'y0', oe.y0, 'x1', oe.x1, 'y1', oe.y1))"
    )


def edges_length(edges: str) -> str:
    return f"aggregate({edges}, 0D, (acc, ed) -> acc + {edge_length('ed')})"


def path_length(path: str) -> str:
    return edges_length(path_edges(path))


def polygon_area(rings: str) -> str:
    return signed_area(polygon_edges(rings))


def with_bounds(df: DataFrame, points: str) -> DataFrame:
    """Add ``xmin,ymin,xmax,ymax`` of an array of points."""
    return df.withColumns(
        {
            f"{axis}{side}": F.expr(f"array_{side}(transform({points}, pt -> pt.{axis}))")
            for side in ("min", "max")
            for axis in ("x", "y")
        }
    )


def tile_index(value: str, size: float) -> str:
    """Tile number of a coordinate; ``floor`` keeps negative coordinates in the right tile."""
    return f"cast(floor(({value}) / {float(size)}D) as bigint)"


def tile_range(low: str, high: str, size: float) -> str:
    return f"sequence({tile_index(low, size)}, {tile_index(high, size)})"


def tile_key(x: str, y: str, size: float) -> str:
    return f"concat_ws(':', {tile_index(x, size)}, {tile_index(y, size)})"


# --- stretches of a segment covered by a polygon -------------------------------------------------


def relative_edges(s: str, edges: str) -> str:
    """Per polygon edge: side of both ends against the line of ``s`` and their positions along it."""
    dx, dy = f"({s}.x1 - {s}.x0)", f"({s}.y1 - {s}.y0)"
    len2 = f"({dx} * {dx} + {dy} * {dy})"

    def side(x: str, y: str) -> str:
        raw = f"({dx} * ({y} - {s}.y0) - {dy} * ({x} - {s}.x0))"
        return f"if(abs({raw}) <= sqrt({len2}) * {ON_LINE_M}D, 0D, {raw})"

    def along(x: str, y: str) -> str:
        return f"(({dx} * ({x} - {s}.x0) + {dy} * ({y} - {s}.y0)) / {len2})"

    row = (
        f"named_struct('sa', {side('re.x0', 're.y0')}, 'sb', {side('re.x1', 're.y1')}, "
        f"'ta', {along('re.x0', 're.y0')}, 'tb', {along('re.x1', 're.y1')})"
    )
    empty = "cast(array() as array<struct<sa:double,sb:double,ta:double,tb:double>>)"
    return f"if({len2} > 0, transform({edges}, re -> {row}), {empty})"


def crossings(relative: str, left: bool) -> str:
    """Sorted positions where the displaced line crosses the polygon outline."""
    above = ">" if left else ">="
    kept = f"filter({relative}, rr -> (rr.sa {above} 0) != (rr.sb {above} 0))"
    return f"array_sort(transform({kept}, rr -> rr.ta + (rr.tb - rr.ta) * (rr.sa / (rr.sa - rr.sb))))"


def spans(positions: str) -> str:
    """Pair sorted crossings into covered stretches, kept to the segment itself (0..1)."""
    pair = "named_struct('t0', greatest(ts[k], 0D), 't1', least(ts[k + 1], 1D))"
    paired = f"filter(transform(sequence(0, size(ts) - 2, 2), k -> {pair}), sp -> sp.t1 - sp.t0 > 1e-12D)"
    return let(positions, "ts", f"if(size(ts) >= 2, {paired}, cast(array() as {SPANS}))")


def with_cover(df: DataFrame, s: str, edges: str) -> DataFrame:
    """Add ``left`` and ``right``: stretches of ``s`` whose side lies in the polygon ``edges``."""
    return (
        df.withColumn("_rel", F.expr(relative_edges(s, edges)))
        .withColumns({"left": F.expr(spans(crossings("_rel", True))), "right": F.expr(spans(crossings("_rel", False)))})
        .drop("_rel")
    )


# --- distances -----------------------------------------------------------------------------------


def point_in_polygon(x: str, y: str, edges: str) -> str:
    """Even-odd ray test; points on the outline are decided by distance, not here."""
    hit = (
        f"(pe.y0 > {y}) != (pe.y1 > {y}) and "
        f"{x} < pe.x0 + ({y} - pe.y0) / nullif(pe.y1 - pe.y0, 0D) * (pe.x1 - pe.x0)"
    )
    return f"(size(filter({edges}, pe -> {hit})) % 2 = 1)"


LINK = "struct<d2:double,px:double,py:double,qx:double,qy:double>"


def link_segment(link: str) -> str:
    return segment(f"{link}.px", f"{link}.py", f"{link}.qx", f"{link}.qy")


def _foot(px: str, py: str, a: str) -> str:
    """Position on the segment ``a`` nearest to a point, between 0 and 1."""
    dx, dy = f"({a}.x1 - {a}.x0)", f"({a}.y1 - {a}.y0)"
    raw = f"(({px} - {a}.x0) * {dx} + ({py} - {a}.y0) * {dy}) / nullif({dx} * {dx} + {dy} * {dy}, 0D)"
    return f"greatest(0D, least(1D, coalesce({raw}, 0D)))"


def nearest_link(s: str, edges: str) -> str:
    """Shortest connection from segment ``s`` to the edges: squared distance and both end points."""
    den = "(({s}.x1 - {s}.x0) * (ne.y1 - ne.y0) - ({s}.y1 - {s}.y0) * (ne.x1 - ne.x0))".format(s=s)
    t = f"(((ne.x0 - {s}.x0) * (ne.y1 - ne.y0) - (ne.y0 - {s}.y0) * (ne.x1 - ne.x0)) / nullif({den}, 0D))"
    u = f"(((ne.x0 - {s}.x0) * ({s}.y1 - {s}.y0) - (ne.y0 - {s}.y0) * ({s}.x1 - {s}.x0)) / nullif({den}, 0D))"
    feet = (
        f"named_struct('e', ne, 'f0', {_foot(f'{s}.x0', f'{s}.y0', 'ne')}, 'f1', {_foot(f'{s}.x1', f'{s}.y1', 'ne')}, "
        f"'g0', {_foot('ne.x0', 'ne.y0', s)}, 'g1', {_foot('ne.x1', 'ne.y1', s)}, "
        f"'t', if({t} between 0 and 1 and {u} between 0 and 1, {t}, null))"
    )

    def at(a: str, axis: str, f: str) -> str:
        # Exact at both ends so that integer input gives exact distances.
        return f"if({f} = 1, {a}.{axis}1, {a}.{axis}0 + {f} * ({a}.{axis}1 - {a}.{axis}0))"

    def ends(px: str, py: str, qx: str, qy: str) -> str:
        return f"named_struct('px', {px}, 'py', {py}, 'qx', {qx}, 'qy', {qy})"

    four = ", ".join(
        [
            ends(f"{s}.x0", f"{s}.y0", at("nf.e", "x", "nf.f0"), at("nf.e", "y", "nf.f0")),
            ends(f"{s}.x1", f"{s}.y1", at("nf.e", "x", "nf.f1"), at("nf.e", "y", "nf.f1")),
            ends(at(s, "x", "nf.g0"), at(s, "y", "nf.g0"), "nf.e.x0", "nf.e.y0"),
            ends(at(s, "x", "nf.g1"), at(s, "y", "nf.g1"), "nf.e.x1", "nf.e.y1"),
        ]
    )
    meet = let(point(at(s, "x", "nf.t"), at(s, "y", "nf.t")), "mp", f"array({ends('mp.x', 'mp.y', 'mp.x', 'mp.y')})")
    links = f"flatten(transform(transform({edges}, ne -> {feet}), nf -> if(nf.t is not null, {meet}, array({four}))))"
    d2 = "(lk.px - lk.qx) * (lk.px - lk.qx) + (lk.py - lk.qy) * (lk.py - lk.qy)"
    measured = f"named_struct('d2', {d2}, 'px', lk.px, 'py', lk.py, 'qx', lk.qx, 'qy', lk.qy)"
    return f"array_min(transform({links}, lk -> {measured}))"


def edges_near(edges: str, s: str, distance: float) -> str:
    """Edges whose bounding box comes within ``distance`` of the bounding box of ``s``."""
    d = f"{float(distance)}D"
    tests = [
        f"least(en.{a}0, en.{a}1) <= greatest({s}.{a}0, {s}.{a}1) + {d} and "
        f"greatest(en.{a}0, en.{a}1) >= least({s}.{a}0, {s}.{a}1) - {d}"
        for a in ("x", "y")
    ]
    return f"filter({edges}, en -> {' and '.join(tests)})"


def capsule_span(s: str, e: str, radius: float) -> str:
    """Stretch of ``s`` within ``radius`` of segment ``e``, or NULL; the region is convex."""
    r = f"{float(radius)}D"
    dx, dy = f"({s}.x1 - {s}.x0)", f"({s}.y1 - {s}.y0)"
    ex, ey = f"({e}.x1 - {e}.x0)", f"({e}.y1 - {e}.y0)"
    base = (
        f"named_struct('len2', {dx} * {dx} + {dy} * {dy}, 'elen2', {ex} * {ex} + {ey} * {ey}, "
        f"'off', {ex} * ({s}.y0 - {e}.y0) - {ey} * ({s}.x0 - {e}.x0), 'off_step', {ex} * {dy} - {ey} * {dx}, "
        f"'foot', {ex} * ({s}.x0 - {e}.x0) + {ey} * ({s}.y0 - {e}.y0), 'foot_step', {ex} * {dx} + {ey} * {dy})"
    )

    def disk(cx: str, cy: str) -> str:
        b = f"({cx} - {s}.x0) * {dx} + ({cy} - {s}.y0) * {dy}"
        c = f"({cx} - {s}.x0) * ({cx} - {s}.x0) + ({cy} - {s}.y0) * ({cy} - {s}.y0) - {r} * {r}"
        moving = (
            "if(dk.b * dk.b >= cb.len2 * dk.c, named_struct('t0', (dk.b - sqrt(dk.b * dk.b - cb.len2 * dk.c)) / cb.len2, "
            "'t1', (dk.b + sqrt(dk.b * dk.b - cb.len2 * dk.c)) / cb.len2), null)"
        )
        # A zero-length segment is inside for all positions or for none.
        still = "if(dk.c <= 0, named_struct('t0', 0D, 't1', 1D), null)"
        return let(f"named_struct('b', {b}, 'c', {c})", "dk", f"if(cb.len2 > 0, {moving}, {still})")

    def band(start: str, step: str, low: str, high: str) -> str:
        """Positions where start + t*step lies in [low, high]."""
        fixed = f"if({start} between {low} and {high}, named_struct('t0', -1e300D, 't1', 1e300D), named_struct('t0', 1e300D, 't1', -1e300D))"
        ends = [f"(({bound} - {start}) / nullif({step}, 0D))" for bound in (low, high)]
        moving = f"named_struct('t0', least({ends[0]}, {ends[1]}), 't1', greatest({ends[0]}, {ends[1]}))"
        return f"if({step} = 0, {fixed}, {moving})"

    both = (
        f"named_struct('across', {band('cb.off', 'cb.off_step', f'-{r} * sqrt(cb.elen2)', f'{r} * sqrt(cb.elen2)')}, "
        f"'beside', {band('cb.foot', 'cb.foot_step', '0D', 'cb.elen2')})"
    )
    strip = let(
        both, "bb", "named_struct('t0', greatest(bb.across.t0, bb.beside.t0), 't1', least(bb.across.t1, bb.beside.t1))"
    )
    parts = (
        f"filter(array({disk(f'{e}.x0', f'{e}.y0')}, {disk(f'{e}.x1', f'{e}.y1')}, if(cb.elen2 > 0, {strip}, null)), "
        "cp -> cp is not null and cp.t0 <= cp.t1)"
    )
    hull = (
        "named_struct('t0', greatest(0D, array_min(transform(ps, p -> p.t0))), "
        "'t1', least(1D, array_max(transform(ps, p -> p.t1))))"
    )
    found = let(parts, "ps", let(hull, "hl", "if(size(ps) > 0 and hl.t0 <= hl.t1, hl, null)"))
    return let(base, "cb", found)


# --- clipping to an axis-aligned window ----------------------------------------------------------


def part_of(s: str, t0: str, t1: str) -> str:
    """Sub-segment between two positions, exact at the ends."""

    def at(axis: str, t: str) -> str:
        return f"case {t} when 0D then {s}.{axis}0 when 1D then {s}.{axis}1 else {s}.{axis}0 + {t} * ({s}.{axis}1 - {s}.{axis}0) end"

    return segment(at("x", t0), at("y", t0), at("x", t1), at("y", t1))


def clip_segment(e: str, x0: str, y0: str, x1: str, y1: str) -> str:
    """Part of a segment in a closed window, or NULL; a touching end gives a zero-length part."""

    def slab(axis: str, low: str, high: str) -> tuple[str, str]:
        start, step = f"{e}.{axis}0", f"({e}.{axis}1 - {e}.{axis}0)"
        a, b = f"(({low}) - {start}) / nullif({step}, 0D)", f"(({high}) - {start}) / nullif({step}, 0D)"
        inside = f"{start} between ({low}) and ({high})"
        return (
            f"if({step} = 0, if({inside}, 0D, 2D), least({a}, {b}))",
            f"if({step} = 0, if({inside}, 1D, -1D), greatest({a}, {b}))",
        )

    (ax, bx), (ay, by) = slab("x", x0, x1), slab("y", y0, y1)
    ends = f"named_struct('low', greatest(0D, {ax}, {ay}), 'high', least(1D, {bx}, {by}))"
    cut = let(ends, "ck", f"if(ck.low <= ck.high, {part_of(e, 'ck.low', 'ck.high')}, null)")
    inside = (
        f"least({e}.x0, {e}.x1) >= ({x0}) and greatest({e}.x0, {e}.x1) <= ({x1}) and "
        f"least({e}.y0, {e}.y1) >= ({y0}) and greatest({e}.y0, {e}.y1) <= ({y1})"
    )
    return f"if({inside}, {e}, {cut})"


def clip_outline(rings: str, x0: str, y0: str, x1: str, y1: str) -> str:
    """Marked edges of the polygon part in a window, by successive half-plane cuts of every ring.

    An outline edge along the window's rim stays real only in the window on its inner side, so every
    stretch of the outline is real in one window.  Drawn edges may run outside a concave polygon, where
    they go back and forth and cancel in the parity of ``crossings`` and in the shoelace sum.
    """
    spot = "array<struct<x:double,y:double,drawn:boolean>>"

    def half_plane(edges: str, axis: str, bound: str, below: bool) -> str:
        compare = "<=" if below else ">="
        a_in, b_in = f"ce.{axis}0 {compare} ({bound})", f"ce.{axis}1 {compare} ({bound})"
        t = f"((({bound}) - ce.{axis}0) / nullif(ce.{axis}1 - ce.{axis}0, 0D))"
        met = (bound, f"ce.y0 + {t} * (ce.y1 - ce.y0)") if axis == "x" else (f"ce.x0 + {t} * (ce.x1 - ce.x0)", bound)

        def at(x: str, y: str, drawn: str) -> str:
            return f"named_struct('x', cast({x} as double), 'y', cast({y} as double), 'drawn', {drawn})"

        step = (
            f"case when {a_in} and {b_in} then array({at('ce.x1', 'ce.y1', 'ce.drawn')}) "
            f"when {a_in} then array({at(*met, 'ce.drawn')}) "
            f"when {b_in} then array({at(*met, 'true')}, {at('ce.x1', 'ce.y1', 'ce.drawn')}) else cast(array() as {spot}) end"
        )
        joined = (
            "zip_with(concat(array(element_at(kp, -1)), slice(kp, 1, size(kp) - 1)), kp, (p, q) -> "
            "named_struct('x0', p.x, 'y0', p.y, 'x1', q.x, 'y1', q.y, 'drawn', q.drawn))"
        )
        return let(
            f"flatten(transform({edges}, ce -> {step}))", "kp",
            f"if(size(kp) > 0, {joined}, cast(array() as array<struct<x0:double,y0:double,x1:double,y1:double,drawn:boolean>>))",
        )

    ring = "ring"
    for axis, bound, below in [("x", x0, False), ("x", x1, True), ("y", y0, False), ("y", y1, True)]:
        ring = half_plane(ring, axis, bound, below)
    outer = (
        f"(we.x0 = we.x1 and ((we.x0 = ({x0}) and we.y1 > we.y0) or (we.x0 = ({x1}) and we.y1 < we.y0))) or "
        f"(we.y0 = we.y1 and ((we.y0 = ({y0}) and we.x1 < we.x0) or (we.y0 = ({y1}) and we.x1 > we.x0)))"
    )
    rim = f"named_struct('x0', we.x0, 'y0', we.y0, 'x1', we.x1, 'y1', we.y1, 'drawn', we.drawn or {outer})"
    cut = f"flatten(transform(transform({ring_edges(rings)}, ring -> {marked('ring')}), ring -> {ring}))"
    return f"transform(filter({cut}, we -> we.x0 <> we.x1 or we.y0 <> we.y1), we -> {rim})"


def inner_point(edges: str, xmin: str, ymin: str, xmax: str, ymax: str) -> str:
    """Point inside a polygon: middle of its widest stretch on the horizontal line at half height."""
    y = f"(({ymin} + {ymax}) / 2D)"
    scan = segment(xmin, y, xmax, y)
    # Edges clear of the line cross it nowhere; they are left out in plain comparisons.
    met = f"filter({edges}, ie -> least(ie.y0, ie.y1) <= {y} + {10 * ON_LINE_M}D and greatest(ie.y0, ie.y1) >= {y} - {10 * ON_LINE_M}D)"
    stretches = let(scan, "sc", spans(crossings(relative_edges("sc", met), True)))
    widest = f"array_max(transform({stretches}, p -> named_struct('w', p.t1 - p.t0, 'n', -p.t0, 't1', p.t1)))"
    at = let(widest, "wd", point(f"{xmin} + (wd.t1 - wd.n) / 2D * ({xmax} - {xmin})", y))
    return at
