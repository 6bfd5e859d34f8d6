"""All registered queries."""

from strollgraph.lattice import (  # noqa: F401
    queries_graph,
    queries_outline,
    queries_prepare,
    queries_region,
    queries_report,
    queries_scalar,
)
from strollgraph.lattice.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
