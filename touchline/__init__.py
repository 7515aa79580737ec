"""touchline: visit-chain attribution on Spark DataFrames.

Collapse versioned visit rows, cut each user's history into chains of
touches at a churn gap, and compute positional attribution and position
metrics per traffic source. Everything is a lazy DataFrame plan.
"""

from touchline.plans.analytics import ChainAnalytics
from touchline.session import get_session

__all__ = ["ChainAnalytics", "get_session"]
