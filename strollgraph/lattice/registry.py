"""Registry of queries on the lattice and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strollgraph.lattice.context import Lattice, lattice
from strollgraph.lattice.sqltext import build

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, **extra: str):
    """Register ``fn(lattice) -> DataFrame`` under ``name`` with an optional SQL twin."""

    def register(fn: Callable[[Lattice], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"Query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(lattice(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = build(sql, **extra)
        return fn

    return register
