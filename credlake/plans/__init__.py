"""Named queries over the driver's tables, each with its DuckDB oracle SQL."""

from credlake.plans import flow_queries, generic_queries, lsh_queries, ml_queries, p0_queries  # noqa: F401
from credlake.plans import io_queries, order_queries, screen_queries, stream_queries  # noqa: F401,E402  (after the batch oracles it reuses)
from credlake.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
