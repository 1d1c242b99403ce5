"""The operators bound to the test tables, each with an equivalent SQL text."""

from querybook.base import ORACLES, QUERIES
from querybook import (  # noqa: F401  (each module registers its queries)
    comparisons,
    flags,
    flows,
    histories,
    lifecycle,
    more_pipelines,
    objectives,
    pipelines,
    selection,
    shaping,
    snapshots,
    writers,
)

__all__ = ["ORACLES", "QUERIES"]
