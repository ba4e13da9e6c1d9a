"""All named queries: importing this module fills the registry."""

from ledgerlens.plans import (  # noqa: F401
    feature_queries,
    metric_queries,
    model_queries,
    quality_queries,
    risk_queries,
)
from ledgerlens.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
