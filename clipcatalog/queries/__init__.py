"""Named queries over the given tables, each with an SQL statement to check it."""

from __future__ import annotations

from clipcatalog.queries.registry import ORACLES, QUERIES
from clipcatalog.queries import (  # noqa: F401  (importing registers the queries)
    q_batch, q_columns, q_evidence, q_joins, q_ranking, q_rollups, q_serving, q_sources, q_streams, q_structured, q_text,
)

__all__ = ["ORACLES", "QUERIES"]
