"""Incremental runs: contacts per tile are kept as a table and finished tiles are skipped.

Results live under ``root/<signature>``; a changed input or setting changes the signature and
starts afresh.  A tile is finished once it stands in the ledger, which is written after its rows,
so a run that lost its cluster goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strollgraph.operators import network as N
from strollgraph.operators import spatial as S


def run_signature(parts: DataFrame) -> str:
    """Digest of a small ``name, value`` table of input digests and settings."""
    pair = F.concat_ws("=", "name", "value")
    row = parts.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(pair)), "\n"), 256).alias("s")).first()
    return row["s"]


def route_tiles(routes: DataFrame, tile: float) -> DataFrame:
    """Tiles that hold any part of a route: ``tile_x, tile_y``."""
    return N.route_pieces(routes, tile, ["route_index"]).select("tile_x", "tile_y").distinct()


def _read(frame: DataFrame, path: str) -> DataFrame | None:
    """The table at ``path``, or None where there is none yet; a table that cannot be read is an error."""
    try:
        return frame.sparkSession.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def open_tiles(tiles: DataFrame, root: str, signature: str) -> DataFrame:
    """Tiles not in the ledger of this signature."""
    ledger = _read(tiles, f"{root}/{signature}/ledger")
    return tiles if ledger is None else tiles.join(ledger.select("tile_x", "tile_y"), ["tile_x", "tile_y"], "left_anti")


def contacts_by_tile(
    shapes: DataFrame,
    routes: DataFrame,
    barriers: DataFrame,
    distance: float,
    tile: float,
    root: str,
    signature: str,
    only: Callable[[DataFrame], DataFrame] | None = None,
    cut=lambda df: df,
) -> DataFrame:
    """Contacts of all tiles, computing only unfinished ones; ``only`` narrows the tiles of this call."""
    todo = open_tiles(route_tiles(routes, tile), root, signature)
    todo = cut(only(todo) if only else todo)
    place = f"{root}/{signature}"
    if not todo.isEmpty():
        here = N.route_pieces(routes, tile, ["route_index"]).join(todo, ["tile_x", "tile_y"], "left_semi")
        wanted = routes.join(here.select("route_index").distinct(), "route_index", "left_semi")
        rows = N.tile_contacts(shapes, wanted, barriers, distance, tile, cut).join(
            todo, ["tile_x", "tile_y"], "left_semi"
        )
        # Dynamic overwrite replaces the partitions of a tile that was written but not yet noted.
        rows.repartition("tile_x", "tile_y", F.pmod(F.xxhash64("node"), F.lit(16))).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("tile_x", "tile_y").parquet(f"{place}/contacts")
        todo.write.mode("append").parquet(f"{place}/ledger")
    stored = _read(routes, f"{place}/contacts")
    if stored is None:
        return N.tile_contacts(shapes, routes.where(F.lit(False)), barriers, distance, tile, cut)
    return stored.withColumns({c: F.col(c).cast("bigint") for c in ("tile_x", "tile_y")})


def refresh_tiles(changed: DataFrame, tile: float, distance: float) -> DataFrame:
    """Tiles whose contacts may change with the given rows (bounds needed)."""
    pad = float(distance)
    x = f"explode(sequence(cast(ceil((xmin - {pad}D) / {tile}D) - 1 as bigint), cast(floor((xmax + {pad}D) / {tile}D) as bigint)))"
    y = x.replace("xm", "ym")
    return changed.select(*S.BOUNDS).selectExpr("*", f"{x} as tile_x").selectExpr("*", f"{y} as tile_y").select(
        "tile_x", "tile_y"
    ).distinct()
