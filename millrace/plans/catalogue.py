"""All registered queries."""

from millrace.plans import log_queries, order_queries, visit_queries  # noqa: F401  (they register)
from millrace.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
