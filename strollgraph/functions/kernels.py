"""The kernels of ``geometry`` over the pairs of a whole Arrow batch.

A pair is a segment ``s`` and marked polygon ``edges``.  The formulas and their order are those of ``relative_edges``, ``crossings``, ``spans``,
``point_in_polygon`` and ``nearest_link``, so results are equal to the last bit; here one array step stands for a tree of expressions per edge.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType, _parse_datatype_string

from strollgraph.functions import geometry as G

ENDS = ("x0", "y0", "x1", "y1")
SPOTS = ("d2", "px", "py", "qx", "qy")
ON_LINE_M = G.ON_LINE_M
#: Edges that are worked on at a time; more rows come in several parts.
PART_EDGES = 100_000

# The functions travel with the job: the workers of a join need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _ends(column: pa.StructArray) -> list[np.ndarray]:
    return [column.field(name).to_numpy(zero_copy_only=False) for name in ENDS]


def _parts(batch: pa.RecordBatch, edges: str) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows that hold few edges together."""
    ends = np.cumsum(batch.column(edges).value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PART_EDGES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _edges(column: pa.ListArray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Ends and mark of all edges, and the row of each."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    return _ends(flat), flat.field("drawn").to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), lengths)


def stretches(s: list[np.ndarray], e: list[np.ndarray], row: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, start and end of the stretches whose left, and of those whose right side lies in the polygon."""
    sx0, sy0, dx, dy = s[0][row], s[1][row], (s[2] - s[0])[row], (s[3] - s[1])[row]
    len2 = dx * dx + dy * dy
    reach = np.sqrt(len2) * ON_LINE_M

    def side(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        raw = dx * (y - sy0) - dy * (x - sx0)
        return np.where(np.abs(raw) <= reach, 0.0, raw)

    sa, sb = side(e[0], e[1]), side(e[2], e[3])
    found = []
    for above in (np.greater, np.greater_equal):
        kept = np.flatnonzero((above(sa, 0) != above(sb, 0)) & (len2 > 0))
        a, b, ux, uy, x, y, l2 = sa[kept], sb[kept], dx[kept], dy[kept], sx0[kept], sy0[kept], len2[kept]
        ta = (ux * (e[0][kept] - x) + uy * (e[1][kept] - y)) / l2
        tb = (ux * (e[2][kept] - x) + uy * (e[3][kept] - y)) / l2
        at, r = ta + (tb - ta) * (a / (a - b)), row[kept]
        order = np.lexsort((at, r))
        at, r = at[order], r[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        first = np.flatnonzero((place[:-1] % 2 == 0) & (r[1:] == r[:-1]))
        t0, t1 = np.maximum(at[first], 0.0) + 0.0, np.minimum(at[first + 1], 1.0)
        real = t1 - t0 > 1e-12
        found.append((r[first][real], t0[real], t1[real]))
    return found


def holds_start(s: list[np.ndarray], e: list[np.ndarray], row: np.ndarray, rows: int) -> np.ndarray:
    """Does the polygon hold the start of the segment (even-odd rule)."""
    x, y = s[0][row], s[1][row]
    hit = ((e[1] > y) != (e[3] > y)) & (x < e[0] + (y - e[1]) / (e[3] - e[1]) * (e[2] - e[0]))
    return np.bincount(row[hit], minlength=rows) % 2 == 1


def nearest(s: list[np.ndarray], e: list[np.ndarray], row: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows that have edges and their shortest connection: squared distance and both end points."""
    s = [c[row] for c in s]
    sdx, sdy, edx, edy = s[2] - s[0], s[3] - s[1], e[2] - e[0], e[3] - e[1]
    den = sdx * edy - sdy * edx
    t = ((e[0] - s[0]) * edy - (e[1] - s[1]) * edx) / den
    u = ((e[0] - s[0]) * sdy - (e[1] - s[1]) * sdx) / den
    meet = (den != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)

    def foot(px, py, a, dx, dy):
        l2 = dx * dx + dy * dy
        raw = np.where(l2 == 0, 0.0, ((px - a[0]) * dx + (py - a[1]) * dy) / l2)
        return np.maximum(np.minimum(raw, 1.0), 0.0) + 0.0

    def at(a, f, dx, dy):
        return np.where(f == 1, a[2], a[0] + f * dx), np.where(f == 1, a[3], a[1] + f * dy)

    cross = at(s, t, sdx, sdy)
    lines = [
        (s[0], s[1], *at(e, foot(s[0], s[1], e, edx, edy), edx, edy)),
        (s[2], s[3], *at(e, foot(s[2], s[3], e, edx, edy), edx, edy)),
        (*at(s, foot(e[0], e[1], s, sdx, sdy), sdx, sdy), e[0], e[1]),
        (*at(s, foot(e[2], e[3], s, sdx, sdy), sdx, sdy), e[2], e[3]),
    ]
    spots = [np.concatenate([np.where(meet, cross[i % 2], line[i]) for line in lines]) for i in range(4)]
    px, py, qx, qy = spots
    d2 = (px - qx) * (px - qx) + (py - qy) * (py - qy)
    every = np.tile(row, 4)
    # The least connection of a row by all its members; only those that tie in distance are sorted.
    least = np.full(int(row.max()) + 1 if len(row) else 0, np.inf)
    np.minimum.at(least, every, d2)
    tied = np.flatnonzero(d2 == least[every])
    order = tied[np.lexsort((qy[tied], qx[tied], py[tied], px[tied], every[tied]))]
    rows, first = np.unique(every[order], return_index=True)
    return rows, [c[order[first]] for c in (d2, px, py, qx, qy)]


def _mapped(df: DataFrame, edges: str, added: str, work: Callable[[pa.RecordBatch], Iterator[tuple]]) -> DataFrame:
    """Columns of ``df`` but ``edges``, and ``added``: ``work`` gives row numbers of a part and the new columns."""
    names = [f.name for f in df.schema if f.name != edges]
    schema = StructType([f for f in df.schema if f.name != edges] + list(_parse_datatype_string(added)))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for part in _parts(batch, edges):
                with np.errstate(all="ignore"):
                    rows, columns = work(part)
                if len(rows):
                    old = part.select(names).take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([*old.columns, *columns], names=schema.names)

    return df.mapInArrow(batches, schema)


def cover_rows(df: DataFrame, s: str, edges: str) -> DataFrame:
    """A row for every stretch of ``s`` whose left or right side lies in the polygon: ``is_left, t0, t1``; ``edges`` go."""

    def work(part):
        e, _drawn, row = _edges(part.column(edges))
        sides = stretches(_ends(part.column(s)), e, row)
        rows, t0, t1 = (np.concatenate(c) for c in zip(*sides))
        is_left = np.arange(len(rows)) < len(sides[0][0])
        return rows, [pa.array(is_left), pa.array(t0), pa.array(t1)]

    return _mapped(df, edges, "is_left boolean, t0 double, t1 double", work)


def _lists(side: tuple[np.ndarray, np.ndarray, np.ndarray], rows: int) -> pa.ListArray:
    row, t0, t1 = side
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(t0), pa.array(t1)], names=["t0", "t1"]))


def links_within(df: DataFrame, s: str, edges: str, distance: float) -> DataFrame:
    """Add ``left``, ``right`` and ``link`` to the pairs within ``distance``; ``edges`` go."""
    limit, pad = float(distance) ** 2, float(distance)

    def work(part):
        seg, (e, drawn, row), n = _ends(part.column(s)), _edges(part.column(edges)), part.num_rows
        sides = stretches(seg, e, row)
        point = (seg[0] == seg[2]) & (seg[1] == seg[3])
        inside = point & holds_start(seg, e, row, n)
        for side in sides:
            inside[side[0]] = True
        link = [np.full(n, np.inf)] + [seg[i].copy() for i in (0, 1, 0, 1)]
        link[0][inside] = 0.0
        near = ~drawn & ~inside[row]
        for k in (0, 1):
            near &= np.minimum(e[k], e[k + 2]) <= np.maximum(seg[k], seg[k + 2])[row] + pad
            near &= np.maximum(e[k], e[k + 2]) >= np.minimum(seg[k], seg[k + 2])[row] - pad
        rows, found = nearest(seg, [c[near] for c in e], row[near])
        for column, values in zip(link, found):
            column[rows] = values
        kept = np.flatnonzero(link[0] <= limit)
        lists = [_lists(side, n).take(pa.array(kept)) for side in sides]
        return kept, [*lists, pa.StructArray.from_arrays([pa.array(c[kept]) for c in link], names=list(SPOTS))]

    return _mapped(df, edges, f"left {G.SPANS}, right {G.SPANS}, link {G.LINK}", work)
