"""All registered queries; importing the modules fills the registry."""

from tallyhouse.plans import (  # noqa: F401
    history_queries, log_queries, model_queries, sales_queries)
from tallyhouse.plans.registry import EXPECTED, QUERIES

__all__ = ["EXPECTED", "QUERIES"]
