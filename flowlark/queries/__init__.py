"""Named queries over the given tables; importing registers them."""

from flowlark.queries import (  # noqa: F401
    documents,
    files,
    keys,
    metrics,
    points,
    project,
    routing,
    stats,
    streams,
    windows,
)
from flowlark.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
