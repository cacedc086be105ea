"""All queries of the engine's own operators."""

from sedimenta.plans import classifier_queries, content_queries, ground_truth_queries, operation_queries, reference_queries, round_trip_queries, site_queries, source_queries, stream_queries, url_queries, value_queries  # noqa: F401
from sedimenta.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "content_queries", "operation_queries", "reference_queries", "url_queries"]
