"""Offline extract: land flagged synthetic pulls as bronze documents.

When a feed cannot be reached, its pull is replaced by a synthetic one that
is shaped like a real answer and flagged ``is_fallback``: feed A with one
document over ``[end - lookback, end]`` (daily and month-start series), feed
B with one document per registry entry. The documents are built by Spark
(``sources/synthetic``) and appended to bronze (``sinks.write_bronze``), so
the refresh parses them like any other pull and the silver dedupe lets any
real observation of the same day win.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indtables.plans.refresh import FEED_A_FOLDER, FEED_B_FOLDER
from indtables.sinks.writers import write_bronze
from indtables.sources.synthetic import (
    PULL_LOOKBACK_DAYS,
    feed_a_fallback_docs,
    feed_b_fallback_docs,
    pull_start,
    registry_frame,
)


def feed_a_pull(spark: SparkSession, end_date: dt.date, lookback_days: int = PULL_LOOKBACK_DAYS) -> DataFrame:
    """One pull request: its window as a one-row DataFrame."""
    end = spark.range(1).select(F.lit(end_date).alias("end_date"))
    return end.select(pull_start(F.col("end_date"), lookback_days).alias("start_date"), "end_date")


def land_fallback_pulls(
    spark: SparkSession,
    bronze_root: str,
    end_date: dt.date,
    failed_a: bool = True,
    failed_b: DataFrame | None = None,
    lookback_days: int = PULL_LOOKBACK_DAYS,
) -> list[str]:
    """Append the synthetic pulls of the failed feeds to bronze.

    ``failed_a``: feed A failed as a whole (it is all real or all synthetic).
    ``failed_b``: registry rows (indicator_id, label) whose feed B call
    failed; default: the whole registry (no token). Returns the folders
    written to."""
    written = []
    if failed_a:
        docs = feed_a_fallback_docs(feed_a_pull(spark, end_date, lookback_days))
        written.append(write_bronze(docs, bronze_root, FEED_A_FOLDER))
    registry = registry_frame(spark) if failed_b is None else failed_b
    written.append(write_bronze(feed_b_fallback_docs(registry), bronze_root, FEED_B_FOLDER))
    return written


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Land synthetic (fallback) pulls in bronze.")
    p.add_argument("bronze_root")
    p.add_argument("--end-date", type=dt.date.fromisoformat, default=dt.date.today())
    p.add_argument("--lookback-days", type=int, default=PULL_LOOKBACK_DAYS)
    args = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    print(land_fallback_pulls(spark, args.bronze_root, args.end_date, lookback_days=args.lookback_days))


if __name__ == "__main__":
    main()
