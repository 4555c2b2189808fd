"""indtables: time-series indicator tables on Spark.

Raw nested observations are conformed to one fact table (silver), deduped
real-before-synthetic, and derived into a long table (change against the
previous observation, 30-day rolling mean) and a wide daily table (one
forward-filled column per indicator over a recent window). Every step is a
DataFrame/SQL plan; nothing passes row data through the driver.
"""

from indtables.operators.conform import accepted, label_for, label_join, parse_feed_a, parse_feed_b, rejected
from indtables.operators.long import gold_long
from indtables.operators.silver import dedupe_observations, enforce_not_null
from indtables.operators.wide import gold_wide
from indtables.plans.query import GoldCatalog
from indtables.plans.refresh import run as refresh

__all__ = [
    "GoldCatalog",
    "accepted",
    "dedupe_observations",
    "enforce_not_null",
    "gold_long",
    "gold_wide",
    "label_for",
    "label_join",
    "parse_feed_a",
    "parse_feed_b",
    "refresh",
    "rejected",
]
