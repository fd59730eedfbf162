"""All registered queries; importing a module below registers its queries."""

from faultlens.plans import alert_queries, change_queries, incidents, log_queries, retrieval_queries, series_queries, stream_queries  # noqa: F401
from faultlens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
