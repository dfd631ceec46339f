"""All named queries; importing this package registers them."""

from larkspur.plans import aggregates, joins, nested, projections, scalars, sets, sources, streams, warehouse, windows  # noqa: F401
from larkspur.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
