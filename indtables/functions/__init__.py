"""Column-level building blocks (all built-in Spark expressions)."""

from indtables.functions.dates import day_month_year, period_start
from indtables.functions.values import exact_mean, exact_sum, feed_a_missing, feed_b_missing, pct_change

__all__ = [
    "day_month_year",
    "exact_mean",
    "exact_sum",
    "feed_a_missing",
    "feed_b_missing",
    "pct_change",
    "period_start",
]
